"""Every registered query at the smallest scale, beside its SQL twin where there is one."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from riskloom.plans.catalogue import catalogue
from riskloom.plans.oracles import oracles
from tests.check_oracles import rows_of

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue(), oracles()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_learned_query_has_a_row_per_user(spark, name):
    users = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    expected = {"model_score_means": 1, "iforest_nodes": None}.get(name, users)
    rows = QUERIES[name](spark, SF).collect()
    assert rows if expected is None else len(rows) == expected
    for row in rows:
        numbers = [v for v in row if isinstance(v, float)]
        assert all(v == v and abs(v) != float("inf") for v in numbers)
