"""Reports on a scored table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.functions.risk import without_nan
from riskloom.operators.risk import ranked
from riskloom.schemas import MODEL_SCORES, PROFILE_AXES, RISK_LEVELS


def filter_scored(
    scored: DataFrame,
    levels: Iterable[str] | None = None,
    low: float = 0.0,
    high: float = 100.0,
    roles: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of the chosen levels, closed score range and, if there is one, roles."""
    keep = F.col("risk_level").isin(list(RISK_LEVELS if levels is None else levels))
    keep &= without_nan(F.col("risk_score")).between(low, high)
    if roles is not None and "role" in scored.columns:
        keep &= F.col("role").isin(list(roles))
    return scored.where(keep)


def top_risky(scored: DataFrame, k: int = 10) -> DataFrame:
    """The k riskiest users with their rank; a top-k heap, no full sort."""
    top = ranked(scored).select("user_id", "role", "risk_score", "risk_level").limit(k)
    order = W.orderBy(without_nan(F.col("risk_score")).desc_nulls_last(), "user_id")
    return top.withColumn("rank", F.row_number().over(order))


def level_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))


def level_shares(scored: DataFrame) -> DataFrame:
    """Count and percentage per level; the total is taken over the level counts."""
    counts = level_counts(scored)
    total = F.sum("n").over(W.partitionBy())  # at most four rows
    return counts.select("risk_level", "n", (F.col("n") * 100.0 / total).alias("pct"))


def _level_count(level: str) -> Column:
    return F.count_if(F.col("risk_level") == level)


def score_stats(scored: DataFrame) -> DataFrame:
    """One row of totals, level counts and score range; no row for an empty table."""
    score = without_nan(F.col("risk_score"))
    return scored.agg(
        F.count(F.lit(1)).alias("total_users"),
        *(_level_count(lv).alias(f"{lv.lower()}_count") for lv in RISK_LEVELS),
        F.avg(score).alias("mean_risk_score"),
        F.max(score).alias("max_risk_score"),
        F.min(score).alias("min_risk_score"),
    ).where("total_users > 0")


def kpis(scored: DataFrame) -> DataFrame:
    score = without_nan(F.col("risk_score"))
    return scored.agg(
        F.count(F.lit(1)).alias("total_users"),
        _level_count("Critical").alias("critical"),
        _level_count("High").alias("high"),
        F.bround(F.avg(score), 1).alias("avg_score"),
        F.bround(F.max(score), 1).alias("max_score"),
    )


def critical_alarm(scored: DataFrame) -> DataFrame:
    """The number of critical users; no row when there are none."""
    return scored.agg(_level_count("Critical").alias("critical_users")).where("critical_users > 0")


def model_score_means(scored: DataFrame) -> DataFrame:
    present = [c for c in MODEL_SCORES if c in scored.columns]
    return scored.agg(*(F.avg(c).alias(f"{c}_mean") for c in present))


def role_level_crosstab(scored: DataFrame) -> DataFrame:
    """Users per role and level. The fixed level list makes the pivot one aggregate."""
    with_role = scored.where(F.col("role").isNotNull())
    return with_role.groupBy("role").agg(*(_level_count(lv).alias(lv) for lv in RISK_LEVELS))


def score_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Users per score bin (1..bins over 0..100) and level; 100 is in the last bin."""
    score = without_nan(F.col("risk_score"))
    bin_no = F.least(F.width_bucket(score, F.lit(0.0), F.lit(100.0), F.lit(bins)), F.lit(bins))
    return (
        scored.where(score.isNotNull())
        .groupBy(bin_no.cast("int").alias("bin"), "risk_level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def alert_table(scored: DataFrame) -> DataFrame:
    """Display columns that exist, rounded half to even."""
    columns = scored.columns
    out: list[Column] = [F.col("user_id")]
    if "role" in columns:
        out.append(F.col("role"))
    out += [F.bround("risk_score", 1).alias("risk_score"), F.col("risk_level")]
    out += [F.bround(c, 3).alias(c) for c in MODEL_SCORES if c in columns]
    out += [F.col(c) for c in ("sensitive_total", "failed_total") if c in columns]
    return scored.select(*out)


def alerts(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("risk_level").isin("Critical", "High"))


def lookup_user(scored: DataFrame, user_id: int) -> DataFrame:
    return scored.where(F.col("user_id") == user_id).limit(1)


def user_cards(scored: DataFrame) -> DataFrame:
    """Drill-down card per row: level, rounded score, title-case role, rule signals."""
    columns = scored.columns
    out: list[Column] = [
        F.col("user_id"),
        F.coalesce("risk_level", F.lit("Unknown")).alias("risk_level"),
        F.bround("risk_score", 1).alias("risk_score"),
    ]
    if "role" in columns:
        out.append(F.initcap("role").alias("role"))
    for c in ("sensitive_total", "failed_total", "usb_total"):
        if c in columns:
            out.append(F.bround(F.col(c).cast("double"), 2).alias(c))
    return scored.select(*out)


def behaviour_profile(table: DataFrame) -> DataFrame | None:
    """Long table (user_id, position, axis, value) of the profile axes that exist, if any."""
    axes = [c for c in PROFILE_AXES if c in table.columns]
    if not axes:
        return None
    points = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(axis).alias("axis"),
            F.col(axis).cast("double").alias("value"),
        )
        for i, axis in enumerate(axes, 1)
    ]
    return table.select("user_id", F.inline(F.array(*points)))


def model_pair_view(scored: DataFrame) -> DataFrame | None:
    """Points of the model comparison, if both model scores exist."""
    if not {"if_score", "svm_score"} <= set(scored.columns):
        return None
    return scored.select("user_id", "if_score", "svm_score", "risk_level", "risk_score")


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    return table.select(column).distinct().orderBy(column)


def full_report(
    scored: DataFrame,
    levels: Iterable[str] | None = None,
    low: float = 0.0,
    high: float = 100.0,
    roles: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """All report tables. Headline numbers and the export ignore the filters."""
    view = filter_scored(scored, levels, low, high, roles)
    out = {
        "kpi": kpis(scored),
        "alerts_export": alerts(scored),
        "view": view,
        "histogram": score_histogram(view),
        "level_shares": level_shares(view),
        "alert_table": alert_table(view),
        "users": distinct_values(view, "user_id"),
        "cards": user_cards(view),
    }
    if "role" in scored.columns:
        out["roles"] = distinct_values(scored, "role")
        out["role_level"] = role_level_crosstab(view)
    optional = {"profile": behaviour_profile(view), "model_pair": model_pair_view(view)}
    return out | {name: table for name, table in optional.items() if table is not None}
