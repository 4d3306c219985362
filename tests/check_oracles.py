"""Run every registered query beside its SQL twin: python tests/check_oracles.py SF_DIR [names]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_point


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    sql, bad = entry_point.oracle_sql(), 0
    for name, query in entry_point.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            got = df.collect()
        except Exception as err:  # report every query, then fail at the end
            bad += 1
            print(f"{name:24s} ERROR {str(err)[:1500]}", flush=True)
            continue
        took = time.time() - started
        if name not in sql:
            print(f"{name:24s} rows={len(got)} {took:.2f}s (no SQL)", flush=True)
            continue
        try:
            result = con.execute(sql[name])
            columns = [c[0] for c in result.description]
            want = result.fetchall()
        except Exception as err:
            bad += 1
            print(f"{name:24s} SQL ERROR {str(err)[:600]}", flush=True)
            continue
        a, b = rows_of(df.columns, got), rows_of(columns, want)
        kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql[name]}").fetchall()}
        same_kinds = kinds == {f.name: KINDS.get(f.dataType.simpleString()) for f in df.schema}
        same = sorted(df.columns) == sorted(columns) and a == b and same_kinds
        print(f"{name:24s} {'ok ' if same else 'BAD'} rows={len(a)}/{len(b)} {took:.2f}s", flush=True)
        if not same:
            bad += 1
            print("   ", df.schema.simpleString(), kinds)
            only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
            for x, y in list(zip(only_a, only_b))[:3]:
                print("    spark", x[:400], "\n    sql  ", y[:400])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
