from pyspark.sql import functions as F

from riskloom.llm.line_dedup import drop_common_lines
from tests.llm import brute
from tests.llm.conftest import EDGE


def result(df, least):
    out = drop_common_lines(df, min_docs=least)
    return sorted(
        ((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=repr
    )


def test_edge_rows(edge):
    for least in (1, 2, 3, 4, 10):
        rows = [(i, t) for i, t, _ in EDGE]
        want = sorted(((i, *r) for (i, _), r in zip(rows, brute.line_dedup(rows, least))), key=repr)
        assert result(edge, least) == want


def test_own_columns_stay_and_outputs_replace(edge):
    out = drop_common_lines(edge, 2)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    row = out.first()
    assert row["digest"] == "own digest" and isinstance(row["n_lines"], int)
    assert row["row"] == "own row" and row["in0"] == "own in0"


def test_empty_table(edge):
    assert drop_common_lines(edge.where("false")).count() == 0


def test_line_in_a_third_of_all_documents(documents_of):
    rows = [(i, f"own {i}\n" + ("Shared Line\n" if i % 3 == 0 else "") + "x") for i in range(60)]
    out = drop_common_lines(documents_of(rows), 15).agg(F.sum("n_dropped")).first()[0]
    assert out == 20 + 60
