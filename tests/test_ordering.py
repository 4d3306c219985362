import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.ordering import before_each, exact_quantile, number_rows


def test_positions_follow_the_key(spark):
    ids = spark.range(0, 500).select((F.col("id") * 37 % 1009).alias("k")).repartition(7)
    numbered, total = number_rows(ids, "k", "pos")
    got = {r["k"]: r["pos"] for r in numbered.collect()}
    assert total == 500
    assert [got[k] for k in sorted(got)] == list(range(1, 501))


@pytest.mark.parametrize("chunk", [3, 1000])
def test_aggregates_before_each_row(spark, chunk):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"i": range(1, 41), "v": rng.integers(0, 50, 40).astype(float)})
    frame["g"] = (frame["i"] - 1) // 15
    df = spark.createDataFrame(frame)
    got = before_each(df, "i", {"v": "min"}, chunk=chunk).orderBy("i").toPandas()
    want = frame["v"].cummin().shift()
    pd.testing.assert_series_equal(got["pre_v"], want, check_names=False)
    got = before_each(df, "i", {"v": "sum"}, group="g", chunk=chunk).orderBy("i").toPandas()
    want = frame.groupby("g")["v"].transform(lambda s: s.cumsum().shift())
    pd.testing.assert_series_equal(got["pre_v"], want, check_names=False)


@pytest.mark.parametrize("bins", [3, 4096])
def test_quantiles_match_linear_interpolation(spark, bins):
    rng = np.random.default_rng(3)
    samples = [
        rng.normal(size=101),
        np.round(rng.normal(size=90), 1),
        np.concatenate([np.zeros(60), rng.normal(size=30), [1e9]]),
        np.array([4.0]),
        np.full(7, 2.5),
        np.array([1.0, 2.0]),
    ]
    for values in samples:
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        for q in (0.05, 0.63, 1.0):
            assert exact_quantile(df, "v", q, bins) == pytest.approx(np.quantile(values, q), abs=1e-12)


def test_quantile_skips_unknown_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert exact_quantile(df, "v", 0.5) == 2.0
    with pytest.raises(ValueError):
        exact_quantile(df.where("v > 5"), "v", 0.5)


def test_quantile_rejects_infinite_values(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "v double")
    with pytest.raises(ValueError, match="infinite"):
        exact_quantile(df, "v", 0.5)
