import random

import pytest

from riskloom.llm.decontaminate import decontaminate, passage_matches
from tests.llm import brute
from tests.llm.conftest import EDGE

ITEM = "id long, text string, note string"


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], ITEM).withColumnRenamed("id", "item_id")


def check(docs, rows, items, items_rows):
    out = decontaminate(docs, items).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in out]
    want = [
        (i, n, hit, ids, hit > 0)
        for (i, _), (n, hit, ids) in zip(rows, brute.contaminated(rows, items_rows))
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, documents_of, seed):
    rng = random.Random(seed)
    words = ["the", "of", "and", "A", "b", "it's", "naïve"] + [f"w{i}" for i in range(8)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 5, 9, 10, 11, 14, 30, 40, 0])]
    items += [(3, text(12)), (None, text(12)), (7, items[7][1]), (11, None), (12, items[7][1])]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            passage = (rng.choice(items)[1] or "").split()
            start = rng.randint(0, max(len(passage) - 10, 0))
            parts += [" ".join(passage[start : start + rng.randint(8, 25)]).upper(), text(rng.randint(0, 3))]
        rows.append((i, ",  ".join(parts)))
    check(documents_of(rows), rows, items_of(spark, items), items)


def test_edge_rows(spark, edge):
    rows = [(i, t) for i, t, _ in EDGE]
    items = [(10, "emoji words and"), (2, "ONE line"), (1, "line here end no"), (None, "no id"), (5, " ")]
    check(edge, rows, items_of(spark, items), items)


def test_empty_tables(spark, edge):
    items = items_of(spark, [(1, "one line")])
    assert decontaminate(edge.where("false"), items).count() == 0
    assert not any(r["contaminated"] for r in decontaminate(edge, items.where("false")).collect())


def test_proximity(spark, documents_of):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = item.replace("delta epsilon", "epsilon delta").replace("zeta", "zeta oh")
    docs = documents_of([(1, f"x {item} y"), (2, f"x {near} y"), (3, "alpha kappa")])
    items = items_of(spark, [(4, item)])
    exact = {r["doc_id"] for r in passage_matches(docs, items).collect()}
    close = {r["doc_id"] for r in passage_matches(docs, items, slop=1).collect()}
    assert exact == {1} and close == {1, 2}


def test_own_columns(spark, edge):
    out = decontaminate(edge, items_of(spark, [(1, "one line")]))
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.first()["pos"] == "own pos"
