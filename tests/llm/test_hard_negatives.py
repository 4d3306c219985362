import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm.hard_negatives import MiningRule, _centres, _Shape, _Walk, mine_hard_negatives

SMALL = dict(scale=1, sample=50, centres=3, page=3, listed=4, stripes=3, most_stripes=3, chunk=2)
KIND = "vec_id long, label int, embedding array<double>"


def brute(rows, is_anchor, rule):
    """Sorted (anchor, positive, rank, negative, scores); rows: (vec_id, label, vector)."""
    rows = [
        (i, label, [math.floor(rule.scale * x) for x in v])
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, label, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j is None, j or 0, own)
            for m, (j, own, w) in enumerate(rows)
            if m != n
        )
        for s, none, j, _ in [x for x in scored if x[3] == label][: rule.positives]:
            fits = [
                x
                for x in scored
                if x[3] != label
                and rule.low_percent * -s <= 100 * -x[0] <= rule.high_percent * -s
            ]
            for rank, x in enumerate(fits[: rule.negatives], 1):
                out.append((i, None if none else j, rank, None if x[1] else x[2], -s, -x[0]))
    return sorted(out, key=repr)


def mined(spark, rows, rule, every=2):
    df = spark.createDataFrame(rows, KIND).withColumns(
        {c: F.lit(f"own {c}") for c in ("row", "anchor", "stripe", "v", "cluster", "rank")}
    )
    out = mine_hard_negatives(df, F.col("vec_id") % every == 0, rule).collect()
    return sorted((tuple(r) for r in out), key=repr)


def even(i):
    return i is not None and i % 2 == 0


def test_random_small_numbers_with_many_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), rng.integers(-1, 3, 4).astype(float).tolist()) for i in range(60)]
    for sizes in (SMALL, {"scale": 1}):
        rule = MiningRule(**sizes)
        assert mined(spark, rows, rule) == brute(rows, even, rule)


def test_clusters_and_other_borders(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 8))
    rows = []
    for i in range(120):
        v = centres[i % 4] + 0.3 * rng.normal(size=8)
        rows.append((i, int(rng.integers(0, 2)), v.tolist()))
    rule = MiningRule(**(SMALL | dict(scale=64, positives=3, negatives=4, low_percent=50, high_percent=95)))
    found = mined(spark, rows, rule)
    assert found and found == brute(rows, even, rule)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [3.0, 4.0]
    rows = [
        (0, 1, same), (2, 1, same), (4, 2, same), (5, 2, same), (5, 2, same), (2, 1, same),
        (None, 1, [3.0, 5.0]), (None, 2, [2.0, 5.0]), (None, 2, [2.0, 5.0]),
        (6, None, same), (8, 1, None), (10, 1, [None, 1.0]), (12, 1, [nan, 1.0]), (14, 1, [inf, 1.0]),
        (16, 3, [0.0, 0.0]), (18, 3, [-3.0, -4.0]), (20, 2, [5.0]), (22, 1, []), (24, 4, [1.0, 1.0]),
    ]
    rule = MiningRule(**SMALL)
    assert mined(spark, rows, rule) == brute(rows, even, rule)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 3, (rng.integers(-9, 9, 3) * 10.0**8 + i).tolist()) for i in range(40)]
    rule = MiningRule(**SMALL)
    assert mined(spark, rows, rule) == brute(rows, even, rule)
    with pytest.raises(Exception, match="62 bits|64 bits"):
        mined(spark, [(0, 1, [4e18, 1.0]), (1, 1, [4e18, 1.0])], rule)


def test_no_rows_no_anchors_one_label(spark):
    rule = MiningRule(**SMALL)
    assert mined(spark, [], rule) == []
    assert mined(spark, [(1, 1, [1.0]), (3, 2, [1.0])], rule) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])], rule) == []


def test_one_vector_for_a_third_of_all_rows(spark):
    rng = np.random.default_rng(9)
    rows = [
        (i, int(rng.integers(0, 4)), ([1.0] * 6 if i % 3 == 0 else rng.normal(size=6).tolist()))
        for i in range(300)
    ]
    rule = MiningRule(**(SMALL | dict(scale=16)))
    found = mined(spark, rows, rule, every=10)
    assert found == brute(rows, lambda i: i % 10 == 0, rule)


def test_members_leave_a_list_early():
    """The bound must certify results before most of a clustered list is scored."""
    rng = np.random.default_rng(10)
    centres = np.eye(6)
    v = (1000 * (centres[np.arange(600) % 6] + 0.02 * rng.normal(size=(600, 6)))).astype(np.int64)
    shape, rule = _Shape(6, "<i4"), MiningRule(chunk=20)
    members = np.arange(0, 600, 60)
    page = {
        "cluster": 0, "id": members.tolist(), "row": members.tolist(), "label": [0] * 10,
        "vectors": v[members].astype("<i4").tobytes(), "low": [[-(1 << 62)]] * 10, "high": [[1 << 62]] * 10,
    }
    other = np.arange(600)
    lists = {
        "other_id": other.tolist(), "other": other.tolist(), "other_label": [0] * 600,
        "vectors": v.astype("<i4").tobytes(),
    }
    walk = _Walk(page, centres, shape, rule, True, 5)
    walk.through(lists)
    assert walk.scored <= 10 * 600 * 0.25
    scores = v[members] @ v.T
    best = {(m, r) for m, _, _, _, _, r in walk.found.tolist()}
    for m in range(10):
        want = [i for i in np.lexsort((other, -scores[m])) if i != members[m]][:5]
        assert {r for k, r in best if k == m} == set(want)


def test_centres_come_from_a_bounded_sample(spark):
    rows = spark.range(500).selectExpr("id as row", "array(id % 7, id % 5 - 2, 1L) as v")
    centres = _centres(rows, _Shape(3, "<i2"), MiningRule(sample=64, centres=4))
    assert centres.shape == (3, 3) and np.allclose(np.linalg.norm(centres, axis=1), 1)
