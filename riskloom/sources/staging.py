"""Intermediate tables in the folder all executors share.

A staged table is computed once, read many times and cuts the lineage: when an
executor is lost its partitions are read again instead of being recomputed.

All of them lie in one folder per application, which the driver's JVM deletes when
it ends; :func:`release` deletes it earlier, once no DataFrame over it is needed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources.tables import hadoop_path

_DIR_KEY = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}  # by application, where no folder is configured
_own_folders: dict[str, str] = {}  # by application


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get(_DIR_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_DIR_KEY} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="riskloom-")
    return _local_folders[application]


def _own_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        folder = f"{shared_dir(spark)}/riskloom-{application}-{uuid.uuid4().hex[:8]}"
        fs, target = hadoop_path(spark, folder)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _own_folders[application] = folder
    return _own_folders[application]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete every staged table of this application."""
    folder = _own_folders.pop(spark.sparkContext.applicationId, None)
    if folder is not None:
        fs, target = hadoop_path(spark, folder)
        fs.delete(target, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
