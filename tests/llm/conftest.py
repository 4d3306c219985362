import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} filler{i % 13}" for i in range(20_000))
#: NULL and empty texts, blanks, a very long text, ties, repeated rows, a missing id.
EDGE = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, LONG, "b"),
    (5, "One line here.\nÄnother LINE here\r\n\nend", "b"),
    (5, "One line here.\nÄnother LINE here\r\n\nend", "b"),
    (6, "one LINE here. \n  änother line here\nend", "c"),
    (None, "One line here.\nno id", "c"),
    (None, None, None),
    (7, "\U0001f600 emoji words and \U0001f600 more\nOne line here.", "a"),
]
CLASHING = ["digest", "row", "key", "N_Lines", "size", "n_words", "kept", "pos", "toxic", "spans", "in0"]


@pytest.fixture(scope="session")
def documents_of(spark):
    """Documents from (doc_id, text[, source]) with columns that bear operators' names."""

    def build(rows):
        rows = [(*r, None)[:3] if len(r) == 2 else r for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})

    return build


@pytest.fixture(scope="session")
def edge(documents_of):
    return documents_of(EDGE)
