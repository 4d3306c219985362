"""Readers and writers of the engine's tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schemas import ACTIVITY_SCHEMA


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in the inputs; Spark aggregates only skip NULL."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *(
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, floats)
            else F.col(f.name)
            for f in df.schema
        )
    )


_NO_VALUE = ("", "nan", "null", "none")
#: Digits of a whole number in CSV text, and of a fraction, which must be zeros.
_NUMBER = "decimal(38, 10)"


def _csv_fields(spark: SparkSession, path: str) -> DataFrame:
    """All fields as text under the header's names, and ``_malformed`` for lines that do not fit.

    Every file has its header checked against the first file's; another order of columns in
    one file is an error, not a silent mix.
    """
    names = spark.read.csv(path, header=True).columns
    missing = [f.name for f in ACTIVITY_SCHEMA if f.name not in names]
    if missing:
        raise ValueError(f"missing column(s) in {path}: {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_malformed"]])
    return spark.read.schema(text).csv(
        path, header=True, enforceSchema=False, columnNameOfCorruptRecord="_malformed"
    )


def _csv_activity(spark: SparkSession, path: str) -> DataFrame:
    """The activity columns with ``record`` (the fields) and ``reasons`` why a line is no row."""
    fields = _csv_fields(spark, path)
    names = [c for c in fields.columns if c != "_malformed"]
    columns, bad = {}, [F.when(F.col("_malformed").isNotNull(), F.lit("line"))]
    for field in ACTIVITY_SCHEMA:
        text = F.trim(F.col(field.name))
        given = F.when(~F.lower(text).isin(*_NO_VALUE), text)
        if isinstance(field.dataType, T.StringType):
            columns[field.name] = F.when(text != "", text)
            continue
        number = given.try_cast(_NUMBER)
        whole = F.when(number == F.floor(number), number).try_cast(field.dataType)
        columns[field.name] = whole
        bad.append(F.when(given.isNotNull() & whole.isNull(), F.lit(field.name)))
    record = F.coalesce("_malformed", F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in names)))
    return fields.select(
        *(value.alias(name) for name, value in columns.items()),
        record.alias("record"),
        F.array_compact(F.array(*bad)).alias("reasons"),
    )


def read_activity(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Activity log with the fixed schema, from Parquet or CSV with a header.

    CSV columns are found by their names in the header, in any order, others are left out.
    Numbers are read exactly, as long as 64 bits hold them; ``3.0``, as often written for
    columns with gaps, is 3, and an empty field, NaN or null is missing. A line that does
    not fit the header, or has a number that is not whole or too large, is no row:
    :func:`rejected_activity` lists it.
    """
    if fmt == "parquet":
        return spark.read.schema(ACTIVITY_SCHEMA).parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported activity format: {fmt}")
    rows = _csv_activity(spark, path).where(F.size("reasons") == 0)
    return rows.select(*(f.name for f in ACTIVITY_SCHEMA))


def rejected_activity(spark: SparkSession, path: str) -> DataFrame:
    """``record`` and ``reasons`` of the CSV lines that :func:`read_activity` leaves out.

    A reason is the name of a column whose number does not fit, or "line".
    """
    rows = _csv_activity(spark, path).where(F.size("reasons") > 0)
    return rows.select("record", "reasons")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, inputs: str = "") -> None:
    """Replace a stored table as a whole: it is written beside the old one, then renamed.

    A note in the folder lists the files and sizes that make up the table, and ``inputs``,
    the fingerprint of what it was made from.
    """
    spark = df.sparkSession
    fresh, stale = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    df.write.mode("overwrite").parquet(fresh)
    note = {"inputs": inputs, "files": _files(spark, fresh)}
    fs, target = hadoop_path(spark, f"{fresh}/{_NOTE}")
    out = fs.create(target)
    out.write(json.dumps(note, sort_keys=True).encode())
    out.close()
    _, old = hadoop_path(spark, path)
    if fs.exists(old):
        fs.rename(old, hadoop_path(spark, stale)[1])
    fs.mkdirs(old.getParent())
    if not fs.rename(hadoop_path(spark, fresh)[1], old):
        raise OSError(f"could not move the new table to {path}")
    delete_path(spark, stale)


_NOTE = "_stored.json"


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files of a table folder with their sizes."""
    fs, target = hadoop_path(spark, path)
    found = ((s.getPath().getName(), s.getLen()) for s in fs.listStatus(target))
    return {name: size for name, size in found if name[0] not in "._"}


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of names, sizes and times of all files below the given paths."""
    lines = []
    for path in paths:
        fs, target = hadoop_path(spark, path)
        if not fs.exists(target):
            lines.append(f"{path} absent")
            continue
        files = fs.listFiles(target, True)
        while files.hasNext():
            s = files.next()
            lines.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()


def stored_table(spark: SparkSession, path: str, inputs: str | None = None) -> DataFrame | None:
    """A table of :func:`write_table`, or None: absent, not whole, or made from other inputs."""
    fs, target = hadoop_path(spark, f"{path}/{_NOTE}")
    if not fs.exists(target):
        return None
    lines = fs.open(target)
    try:
        note = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(lines, "UTF-8"))
    except ValueError:
        return None
    except Py4JJavaError as error:
        if "ChecksumException" in str(error.java_exception):
            return None
        raise
    finally:
        lines.close()
    if note.get("files") != _files(spark, path) or inputs not in (None, note.get("inputs")):
        return None
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """File system and path object of a location, whatever its scheme."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def load_or_compute(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], *inputs: str
) -> DataFrame:
    """The stored table; it is computed and stored if it is absent, broken or out of date.

    ``inputs`` are the files or folders it is made from: when any of them has changed since,
    the stored table does not count.
    """
    made_from = fingerprint(spark, *inputs)
    stored = stored_table(spark, path, made_from)
    if stored is None:
        write_table(compute(), path, made_from)
        stored = stored_table(spark, path, made_from)
    return stored


def write_alerts_csv(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("overwrite").csv(path, header=True)
