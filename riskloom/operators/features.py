"""Behaviour features per user.

The 18 features derive from *user statistics*: counts, sums, sums of squares
and maxima that merge by addition and maximum. Batch and stream share them: a
batch builds them with one aggregate, a stream adds each micro-batch to the
stored ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.sources.staging import stage

# statistic -> (measured column, day kind or None for all days)
_COUNTED = {
    "login": ("login_hour", None),
    "files": ("files_accessed", None),
    "emails": ("emails_sent", None),
    "after": ("after_hours", None),
    "we_files": ("files_accessed", 1),
    "we_login": ("login_hour", 1),
    "we_after": ("after_hours", 1),
    "wd_files": ("files_accessed", 0),
}
_SQUARED = {"login": "login_hour", "files": "files_accessed"}
_MAXIMA = {"files": "files_accessed", "emails": "emails_sent", "after": "after_hours"}
_TOTALS = {
    "failed_total": "failed_logins",
    "sensitive_total": "sensitive_files",
    "usb_total": "usb_usage",
    "vpn_total": "vpn_connections",
}
_ADDED = (
    [f"{s}_{part}" for s in _COUNTED for part in ("n", "sum")]
    + [f"{s}_sq" for s in _SQUARED]
    + list(_TOTALS)
)
_KEPT_MAX = [f"{s}_max" for s in _MAXIMA]


def _exact(whole: str) -> str:
    """Whole numbers whose products and sums are exact, up to 38 digits."""
    return f"CAST({whole} AS DECIMAL(19, 0))"


def user_stats(activity: DataFrame) -> DataFrame:
    """Mergeable statistics per user.

    Rows are first reduced per (user, role): with the role among the keys every
    aggregation buffer is numeric, so the large input runs through a hash
    aggregate. Only its output, about one row per user, meets the aggregate that
    picks the first role.
    """
    aggs = [F.expr("min(day) AS _day")]
    for stat, (column, kind) in _COUNTED.items():
        value = column if kind is None else f"CASE WHEN is_weekend = {kind} THEN {column} END"
        aggs += [F.expr(f"count({value}) AS {stat}_n"), F.expr(f"sum({value}) AS {stat}_sum")]
    for stat, column in _SQUARED.items():
        aggs.append(F.expr(f"sum({_exact(column)} * {_exact(column)}) AS {stat}_sq"))
    aggs += [F.expr(f"sum({column}) AS {total}") for total, column in _TOTALS.items()]
    aggs += [F.expr(f"bigint(max({column})) AS {stat}_max") for stat, column in _MAXIMA.items()]
    per_role = activity.where("user_id IS NOT NULL").groupBy("user_id", "role").agg(*aggs)
    first_role = F.expr("CASE WHEN role IS NOT NULL THEN struct(_day, role) END")
    return _combine(per_role.withColumn("first_role", first_role))


#: Columns of one user's statistics in flat form, with the day that the first role is of.
FLAT_STATS = {
    **{c: "decimal(38,0)" if c.endswith("_sq") else "long" for c in _ADDED},
    **{c: "long" for c in _KEPT_MAX},
    "role_day": "int",
    "role": "string",
}


def row_stats(activity: DataFrame) -> DataFrame:
    """Each row's own statistics, flat, with its ``user_id`` and ``day``."""
    columns = ["user_id", "day"]
    for stat, (column, kind) in _COUNTED.items():
        value = column if kind is None else f"CASE WHEN is_weekend = {kind} THEN {column} END"
        columns += [f"bigint({value} IS NOT NULL) AS {stat}_n", f"bigint({value}) AS {stat}_sum"]
    for stat, column in _SQUARED.items():
        square = f"{_exact(column)} * {_exact(column)}"
        columns.append(f"CAST({square} AS DECIMAL(38, 0)) AS {stat}_sq")
    columns += [f"bigint({column}) AS {total}" for total, column in _TOTALS.items()]
    columns += [f"bigint({column}) AS {stat}_max" for stat, column in _MAXIMA.items()]
    columns += ["CASE WHEN role IS NOT NULL THEN day END AS role_day", "role"]
    return activity.selectExpr(*columns)


def flat_merger() -> Callable[[list, Sequence], None]:
    """A function that adds flat statistics, in the order of ``FLAT_STATS``, to others in place.

    It needs nothing of this module, so Spark can send it to where the package is not.
    """
    added, most = len(_ADDED), len(_KEPT_MAX)

    def order(day: int | None, role: str) -> tuple:
        return day is not None, day or 0, role

    def merge(stats: list, more: Sequence) -> None:
        for i, value in enumerate(more[:added]):
            if value is not None:
                stats[i] = value if stats[i] is None else stats[i] + value
        for i, value in enumerate(more[added : added + most], added):
            if value is not None and (stats[i] is None or value > stats[i]):
                stats[i] = value
        day, role = more[-2:]
        if role is not None and (stats[-1] is None or order(day, role) < order(*stats[-2:])):
            stats[-2:] = day, role

    return merge


def stats_of_flat(flat: DataFrame, prefix: str = "") -> DataFrame:
    """User statistics as :func:`user_stats` gives them, from flat columns with a prefix."""
    name = lambda c: F.col(prefix + c)
    first = F.struct(name("role_day").alias("_day"), name("role").alias("role"))
    return flat.select(
        "user_id",
        *(name(c).alias(c) for c in [*_ADDED, *_KEPT_MAX]),
        F.when(name("role").isNotNull(), first).alias("first_role"),
    )


def _combine(rows: DataFrame) -> DataFrame:
    merged = [f"sum({c}) AS {c}" for c in _ADDED] + [f"max({c}) AS {c}" for c in _KEPT_MAX]
    merged.append("min(first_role) AS first_role")
    return rows.groupBy("user_id").agg(*map(F.expr, merged))


def merge_stats(old: DataFrame, new: DataFrame) -> DataFrame:
    """Statistics of the two inputs' rows together; each has one row per user."""
    return _combine(old.unionByName(new))


def risk_totals(activity: DataFrame) -> DataFrame:
    """Only what the rule signals need: role and the two totals per user."""
    totals = ["sensitive_total", "failed_total"]
    per_role = (
        activity.where(F.col("user_id").isNotNull())
        .groupBy("user_id", "role")
        .agg(*(F.sum(_TOTALS[t]).alias(t) for t in totals), F.min("day").alias("_day"))
    )
    first = F.min(F.when(F.col("role").isNotNull(), F.struct("_day", "role")))
    return (
        per_role.groupBy("user_id")
        .agg(first.alias("_first"), *(F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in totals))
        .select("user_id", F.coalesce("_first.role", F.lit("unknown")).alias("role"), *totals)
    )


def totals_from_stats(stats: DataFrame) -> DataFrame:
    """The columns of :func:`risk_totals`, from stored statistics."""
    return stats.select(
        "user_id",
        F.coalesce("first_role.role", F.lit("unknown")).alias("role"),
        *(F.coalesce(t, F.lit(0)).alias(t) for t in ("sensitive_total", "failed_total")),
    )


def _mean(stat: str) -> str:
    return f"try_divide(double({stat}_sum), {stat}_n)"


def _sample_std(stat: str) -> str:
    """NULL for fewer than two values. The difference of squares is taken without rounding."""
    spread = f"{_exact(stat + '_n')} * {stat}_sq - {_exact(stat + '_sum')} * {_exact(stat + '_sum')}"
    return f"CASE WHEN {stat}_n > 1 THEN sqrt(double({spread}) / {stat}_n / ({stat}_n - 1)) END"


def distinct_days(activity: DataFrame) -> DataFrame:
    """One row, ``n_days``. Days are de-duplicated before the shuffle."""
    return activity.agg(F.count_distinct("day").alias("n_days"))


def day_kind_means(stats: DataFrame) -> DataFrame:
    """Weekend and weekday means per user; NULL without such days."""
    return stats.selectExpr(
        "user_id",
        f"{_mean('we_files')} AS weekend_files",
        f"{_mean('we_login')} AS weekend_logins",
        f"{_mean('we_after')} AS weekend_after_hours",
        f"{_mean('wd_files')} AS weekday_files",
    )


def features_from_stats(stats: DataFrame, n_days: Column) -> DataFrame:
    """``user_id``, ``role`` and the 18 raw features; missing values become 0.

    ``n_days`` is the number of distinct days of the whole processed log.
    """
    per_user = {
        "login_mean": _mean("login"),
        "login_std": _sample_std("login"),
        "files_mean": _mean("files"),
        "files_max": "files_max",
        "files_std": _sample_std("files"),
        "failed_total": "failed_total",
        "sensitive_total": "sensitive_total",
        "emails_mean": _mean("emails"),
        "emails_max": "emails_max",
        "usb_total": "usb_total",
        "after_hours_mean": _mean("after"),
        "after_hours_max": "after_max",
        "vpn_total": "vpn_total",
    }
    ratios = {
        "sensitive_ratio": "sensitive_total / (files_mean * _days + 1)",
        "failed_login_rate": "failed_total / _days",
        "usb_rate": "usb_total / _days",
        "vpn_rate": "vpn_total / _days",
        "weekend_activity_ratio": "coalesce(_weekend, 0D) / (coalesce(_weekday, 1D) + 1)",
    }
    base = stats.withColumn("_n_days", n_days).selectExpr(
        "user_id",
        "coalesce(first_role.role, 'unknown') AS role",
        *(f"coalesce(double({e}), 0D) AS {name}" for name, e in per_user.items()),
        f"{_mean('we_files')} AS _weekend",
        f"{_mean('wd_files')} AS _weekday",
        "double(nullif(_n_days, 0)) AS _days",
    )
    return base.selectExpr(
        "user_id",
        "role",
        *per_user,
        *(f"coalesce({e}, 0D) AS {name}" for name, e in ratios.items()),
    )


def stored_stats(activity: DataFrame) -> tuple[DataFrame, int]:
    """User statistics as a staged table, and the number of distinct days.

    The calendar days are observed while the rows flow into the statistics, so
    the activity is read and shuffled once.
    """
    days = Observation()
    watched = activity.observe(days, F.size(F.collect_set("day")).alias("n_days"))
    stats = stage(user_stats(watched), "user-stats")
    if stats.isEmpty():  # the observation of an empty plan never fires
        return stats, 0
    return stats, days.get["n_days"]


def user_features(activity: DataFrame) -> DataFrame:
    """Raw features of every user of an activity log."""
    stats, n_days = stored_stats(activity)
    return features_from_stats(stats, F.lit(n_days))
