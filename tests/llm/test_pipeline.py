from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from riskloom.llm.oracles import oracles
from riskloom.llm.queries import queries

SF = "/root/testdata/sf0.001"
#: Queries with rows of their own; their SQL says how many.
PAIRS = ("op12_hard_negatives", "op13_source_divergence")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    got = df.collect()
    if name == "op10_chat_format":
        assert len(got) == con.execute("SELECT count(DISTINCT conv_id) + 1 FROM conversations").fetchone()[0]
    elif name not in PAIRS:
        assert len(got) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    if name in oracles():
        result = con.execute(oracles()[name])
        columns = [c[0] for c in result.description]
        assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())


def test_pipeline_matches_its_sql(spark, con):
    df = corpus_pipeline.run(spark, SF)
    result = con.execute(corpus_pipeline.ORACLE_SQL)
    columns = [c[0] for c in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_stages_take_rows_with_nulls_and_no_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "some text of an unknown document", "en", None, 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for rows in (docs, docs.union(docs), docs.where("false")):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, rows, SF)
            if name != "source_mixing":
                assert out.columns == docs.columns
            assert out.count() <= rows.count()


def test_registered():
    found = entry_point.queries()
    assert {"pipeline", *queries()} <= found.keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
