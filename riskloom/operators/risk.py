"""Risk scoring over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import risk as fn
from riskloom.params import RiskParams


def with_raw_risk(df: DataFrame, params: RiskParams) -> DataFrame:
    return df.withColumn("risk_score_raw", fn.raw_risk(df.columns, params))


def raw_range(df: DataFrame) -> DataFrame:
    """One row: smallest and largest raw risk, skipping NULL and NaN."""
    raw = fn.without_nan(F.col("risk_score_raw"))
    return df.agg(F.min(raw).alias("low"), F.max(raw).alias("high"))


def with_levels(df: DataFrame, params: RiskParams) -> DataFrame:
    """Add ``risk_score`` (0-100 over all rows of ``df``) and ``risk_level``.

    The range is a one-row scalar subquery, so rows are neither shuffled nor
    joined. ``df`` is read twice: pass a stored or staged table.
    """
    bounds = raw_range(df).select(F.struct("low", "high").alias("b")).scalar()
    score = fn.scale_to_100(F.col("risk_score_raw"), F.col("_b.low"), F.col("_b.high"))
    return (
        df.withColumn("_b", bounds)
        .withColumn("risk_score", score)
        .drop("_b")
        .withColumn("risk_level", fn.risk_level(F.col("risk_score"), params))
    )


def ranked(scored: DataFrame) -> DataFrame:
    """Highest risk first; unknown scores last, ties by user."""
    return scored.orderBy(F.desc_nulls_last(fn.without_nan(F.col("risk_score"))), "user_id")


def breakdown(scored: DataFrame, params: RiskParams) -> DataFrame:
    """Long table (user_id, factor, contribution_pct) of the named risk factors."""
    pairs = [
        F.struct(F.lit(name).alias("factor"), share.alias("contribution_pct"))
        for name, share in fn.factor_shares(scored.columns, params)
    ]
    return scored.select("user_id", F.inline(F.array(*pairs)))


def breakdown_of(scored: DataFrame, user_id: int, params: RiskParams) -> DataFrame:
    """Breakdown of one user, smallest contribution first."""
    one = scored.where(F.col("user_id") == user_id).limit(1)
    return breakdown(one, params).orderBy("contribution_pct", "factor")
