"""Column expressions of the risk score. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.params import RiskParams
from riskloom.schemas import FACTOR_NAMES


def column_or_zero(name: str, columns: list[str]) -> Column:
    """A column of the table, or 0 when the table does not have it."""
    return F.col(name).cast("double") if name in columns else F.lit(0.0)


def raw_risk(columns: list[str], params: RiskParams) -> Column:
    """Weighted sum of model scores and rule signals; NULL in any term stays NULL."""
    total: Column | None = None
    for name, weight in params.weights.items():
        term = F.lit(float(weight)) * column_or_zero(name, columns)
        total = term if total is None else total + term
    return total


def without_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def scale_to_100(raw: Column, low: Column, high: Column) -> Column:
    """Min-max scaling; 0 for everyone when all raw risks are equal."""
    return F.when(low == high, raw * 0.0).otherwise((raw - low) / (high - low) * 100.0)


def risk_level(score: Column, params: RiskParams) -> Column:
    """Level of a score. NULL fails every comparison and NaN is excluded: "Low"."""
    known = without_nan(score)
    return (
        F.when(known >= params.critical, F.lit("Critical"))
        .when(known >= params.high, F.lit("High"))
        .when(known >= params.medium, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def factor_shares(columns: list[str], params: RiskParams) -> list[tuple[str, Column]]:
    """(factor, percentage) pairs relative to the absolute risk score, or to 1 if 0."""
    if "risk_score" in columns:
        size = F.abs(F.col("risk_score"))
        size = F.when(size == 0, F.lit(1.0)).otherwise(size)
    else:
        size = F.lit(1.0)
    return [
        (
            FACTOR_NAMES[name],
            F.bround(F.lit(float(weight)) * column_or_zero(name, columns) / size * 100, 1),
        )
        for name, weight in params.weights.items()
    ]
