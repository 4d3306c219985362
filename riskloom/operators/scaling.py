"""Standard scaling with the population standard deviation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import FEATURE_COLS, require_features


def fit_scaler(features: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    """Long table ``feature, mean, std``: one row per column, from one aggregate."""
    require_features(features.columns, columns)
    wide = features.agg(
        *(
            F.expr(f"struct('{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std) AS {c}")
            for c in columns
        )
    )
    return wide.selectExpr(f"inline(array({', '.join(columns)}))")


def scaler_lookup(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """The scaler as literals for a projection; it has one row per feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in scaler.collect()}


def zscore(value: Column, mean: float, std: float) -> Column:
    """Constant columns keep divisor 1, so they scale to 0."""
    return (value.cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)


def apply_scaler(features: DataFrame, lookup: dict[str, tuple[float, float]]) -> DataFrame:
    require_features(features.columns, list(lookup))
    return features.withColumns({c: zscore(F.col(c), m, s) for c, (m, s) in lookup.items()})


def scale(features: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    """Fit and apply in one plan: each mean and std is a one-row scalar subquery."""
    require_features(features.columns, columns)
    stats = features.agg(
        *(F.expr(f"avg({c}) AS {c}_m") for c in columns),
        *(F.expr(f"stddev_pop({c}) AS {c}_s") for c in columns),
    )
    one_row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    scaled = {
        c: F.expr(f"({c} - _s.{c}_m) / CASE WHEN _s.{c}_s = 0 THEN 1D ELSE _s.{c}_s END")
        for c in columns
    }
    return features.withColumn("_s", one_row).withColumns(scaled).drop("_s")
