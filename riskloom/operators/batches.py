"""Replay batches of users and the metadata each batch leaves behind."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import risk as fn
from riskloom.functions.ordering import CHUNK, before_each, number_rows
from riskloom.params import RiskParams
from riskloom.sources.staging import stage


def user_batches(users: DataFrame, batch_size: int) -> DataFrame:
    """Number users into batches in ascending id order.

    ``users`` has one row per user and keeps its columns. Adds ``batch_num``,
    ``total_batches``, ``users_in_batch`` and ``total_users_processed`` (so far).
    """
    numbered, total = number_rows(users, "user_id", "_pos")
    batches = -(-total // batch_size)
    batch = F.ceil(F.col("_pos") / batch_size)
    done = F.least(batch * batch_size, F.lit(total))
    return numbered.select(
        *users.columns,
        batch.cast("int").alias("batch_num"),
        F.lit(batches).cast("int").alias("total_batches"),
        (done - (batch - 1) * batch_size).cast("int").alias("users_in_batch"),
        done.cast("int").alias("total_users_processed"),
    )


def batch_metadata(
    raw: DataFrame, batch_size: int, params: RiskParams, chunk: int = CHUNK
) -> DataFrame:
    """One row per replay batch: sizes and High/Critical counts of all users so far.

    Every batch re-normalises all users seen up to it, so a level depends on the
    range of raw risks up to that batch. The range changes only when a batch
    brings a new extreme; batches between two changes form a *period* with
    constant levels. A user is classified with its own period's range when it
    arrives; users of earlier periods are counted by :func:`_carried_counts`.
    """
    risk = raw.select("user_id", fn.without_nan(F.col("risk_score_raw")).alias("raw"))
    rows = user_batches(risk, batch_size)
    sizes = ["total_batches", "users_in_batch", "total_users_processed"]

    def before(table: DataFrame, columns: dict[str, str], group: str | None = None) -> DataFrame:
        return before_each(table, "batch_num", columns, group, chunk)

    per_batch = rows.groupBy("batch_num", *sizes).agg(
        F.min("raw").alias("low"), F.max("raw").alias("high")
    )
    ranges = before(per_batch, {"low": "min", "high": "max"})
    new_extreme = (F.col("low") < F.col("pre_low")) | (F.col("high") > F.col("pre_high"))
    ranges = ranges.select(
        "batch_num",
        *sizes,
        F.least("low", "pre_low").alias("low"),
        F.greatest("high", "pre_high").alias("high"),
        F.when(F.col("pre_low").isNull() | new_extreme, 1).otherwise(0).alias("start"),
    )
    periods = before(ranges, {"start": "sum"})
    period = F.col("start") + F.coalesce("pre_start", F.lit(0))
    periods = stage(periods.withColumn("period", period).drop("pre_start"), "periods")
    placed = rows.select("batch_num", "raw").join(periods.drop("start"), "batch_num")
    arrived = placed.groupBy("batch_num", *sizes, "period").agg(
        _level(params, "High").alias("high"), _level(params, "Critical").alias("critical")
    )
    counts = before(arrived, {"high": "sum", "critical": "sum"}, group="period")
    starts = periods.where("start = 1").select("period", "low", "high")
    carried = _carried_counts(placed.select("raw", "period"), starts, params, chunk)
    counts = counts.join(carried, "period", "left")

    def upto(level: str) -> Column:
        earlier = F.coalesce(f"pre_{level}", F.lit(0)) + F.coalesce(f"{level}_old", F.lit(0))
        return (F.col(level) + earlier).alias(f"{level}_risk_count")

    return counts.select("batch_num", *sizes, upto("high"), upto("critical"))


def _level(params: RiskParams, level: str) -> Column:
    """Users of a level; ``low`` and ``high`` are the range of their batch."""
    score = fn.scale_to_100(F.col("raw"), F.col("low"), F.col("high"))
    return F.count_if(fn.risk_level(score, params) == level)


def _cutoffs(level: float) -> Column:
    """The smallest raw risk that scores ``level`` or more in the range low .. high."""

    def smallest(low: pd.Series, high: pd.Series) -> pd.Series:
        a, b = low.to_numpy(float), high.to_numpy(float)
        score = lambda raw: (raw - a) / (b - a) * 100.0
        cut = a + level / 100.0 * (b - a)
        # Rounding leaves the estimate a few steps off; the score never falls as risk rises.
        while (short := score(cut) < level).any():
            cut = np.where(short, np.nextafter(cut, np.inf), cut)
        while (loose := score(below := np.nextafter(cut, -np.inf)) >= level).any():
            cut = np.where(loose, below, cut)
        return pd.Series(cut)

    return F.pandas_udf(smallest, "double")("low", "high")


def _carried_counts(
    users: DataFrame, starts: DataFrame, params: RiskParams, chunk: int
) -> DataFrame:
    """Per period: High/Critical among the users of earlier periods, by its range.

    ``users`` has ``raw`` and the ``period`` of arrival, ``starts`` the range of each
    period. A user counts for a threshold of period p if it arrived before p and its
    risk reaches the threshold: dominance counting in two coordinates. Thresholds are
    ranked by value, and a user's risk becomes the number of thresholds it reaches.
    The periods before p are a union of dyadic blocks, one for each bit of p; in each
    block a running sum over falling ranks gives the users that reach a threshold. The
    plan is the same for any number of periods and moves users x log2(periods) rows
    at most, without a (user, period) pair.
    """
    ranges = starts.where("low < high")
    cuts = F.array(
        *(
            F.struct(F.lit(name).alias("kind"), _cutoffs(float(level)).alias("cut"))
            for name, level in (("high", params.high), ("critical", params.critical))
        )
    )
    thresholds = ranges.select("period", F.explode(cuts).alias("c")).select(
        "period", "c.kind", F.col("c.cut").alias("value")
    )
    known = users.where("raw is not null")
    both = thresholds.select(
        F.struct("value", F.lit(0).alias("after"), "period", "kind").alias("key"),
        "period",
        "kind",
        F.lit(1).alias("step"),
        F.lit(0).cast("long").alias("n"),
    ).unionByName(
        known.groupBy("raw", "period")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.struct(
                F.col("raw").alias("value"),
                F.lit(1).alias("after"),
                "period",
                F.lit("").alias("kind"),
            ).alias("key"),
            "period",
            F.lit(None).cast("string").alias("kind"),
            F.lit(0).alias("step"),
            "n",
        )
    )
    numbered, _ = number_rows(both, "key", "nth")
    ranked = before_each(numbered, "nth", {"step": "sum"}, chunk=chunk)
    rank = F.coalesce("pre_step", F.lit(0)) + F.col("step")
    ranked = stage(ranked.select("period", "kind", "n", rank.alias("rank")), "ranked")

    levels = F.floor(F.log2(F.greatest(starts.agg(F.max("period")).scalar(), F.lit(1)))).cast("int")
    cells = (
        ranked.where("kind is null and rank > 0")
        .groupBy("rank", "period")
        .agg(F.sum("n").alias("n"))
        .withColumn("level", F.explode(F.sequence(F.lit(0), levels)))
        .withColumn("block", F.expr("shiftright(period, level)"))
        .where("block % 2 = 0")
        .groupBy("level", "block", "rank")
        .agg(F.sum("n").alias("n"))
        .select("level", "block", "rank", "n", F.lit(None).cast("long").alias("period"), F.lit("").alias("kind"))
    )
    asked = (
        ranked.where("kind is not null")
        .withColumn("level", F.explode(F.sequence(F.lit(0), levels)))
        .where("shiftright(period, level) % 2 = 1")
        .select(
            "level",
            (F.expr("shiftright(period, level)") - 1).alias("block"),
            "rank",
            F.lit(0).cast("long").alias("n"),
            "period",
            "kind",
        )
    )
    falling = F.struct(
        "level",
        "block",
        (-F.col("rank")).alias("rank"),
        F.col("period").isNotNull().alias("asks"),
        F.coalesce("period", F.lit(0)).alias("period"),
        "kind",
    )
    together = cells.unionByName(asked).withColumn("key", falling)
    group = F.concat_ws(":", "level", "block")
    ordered, _ = number_rows(together.withColumn("group", group), "key", "nth")
    summed = before_each(ordered, "nth", {"n": "sum"}, group="group", chunk=chunk)
    found = (
        summed.where("period is not null")
        .groupBy("period")
        .agg(
            *(
                F.sum(F.when(F.col("kind") == k, F.coalesce("pre_n", F.lit(0)))).alias(k)
                for k in ("high", "critical")
            )
        )
    )
    return found.select(
        "period",
        (F.col("high") - F.col("critical")).alias("high_old"),
        F.col("critical").alias("critical_old"),
    )


def latest_metadata(metadata: DataFrame) -> DataFrame:
    """The row of the highest batch number."""
    return metadata.orderBy(F.desc("batch_num")).limit(1)


def batch_progress(metadata: DataFrame, batch_size: int) -> DataFrame:
    """Status line per batch; the clock column appears when there is a timestamp."""
    out = [
        F.col("batch_num"),
        F.format_string("Batch %d/%d", "batch_num", "total_batches").alias("batch_text"),
        F.col("total_users_processed"),
        F.format_string(
            "%d Critical + %d High risk users detected", "critical_risk_count", "high_risk_count"
        ).alias("alert_text"),
        F.least(
            F.col("total_users_processed") / (F.col("total_batches") * F.lit(float(batch_size))),
            F.lit(1.0),
        ).alias("progress"),
    ]
    if "timestamp" in metadata.columns:
        out.append(F.date_format(F.to_timestamp("timestamp"), "HH:mm:ss").alias("updated_at"))
    return metadata.select(*out)
