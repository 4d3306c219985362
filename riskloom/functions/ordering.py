"""Global row numbers, running aggregates and exact quantiles without a single-task step."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.sources.staging import stage


def number_rows(df: DataFrame, key: str, out: str) -> tuple[DataFrame, int]:
    """Add the 1-based position of each row in ascending order of a unique ``key``.

    Also returns the number of rows.

    Rows are range-partitioned and numbered inside their partition; the table of
    partition sizes, one row per partition, gives each partition its offset.
    The numbered rows are staged because range bounds are sampled per execution.
    """
    row_id = F.monotonically_increasing_id()
    placed = stage(df.orderBy(key).withColumn("_id", row_id), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.join(F.broadcast(offsets), "_part")  # one row per partition
    position = (F.col("_offset") + within + 1).alias(out)
    return numbered.select(*df.columns, position), placed.count()


CHUNK = 10_000


def before_each(
    df: DataFrame,
    order: str,
    columns: dict[str, str],
    group: str | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Aggregates over all rows before each row, by a 1-based dense integer ``order``.

    ``columns`` maps a column to "sum", "min" or "max"; each gains a
    ``pre_<column>``, NULL where nothing comes before. Chunks of consecutive
    rows run in parallel; a second window over one row per chunk carries their
    totals on. With ``group`` the aggregates restart for each of its values.
    """
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    keys = [group] if group else []
    df = df.withColumn("_chunk", F.floor((F.col(order) - 1) / chunk))
    inside = W.partitionBy("_chunk", *keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumns({f"pre_{c}": fold[kind](c).over(inside) for c, kind in columns.items()})
    totals = df.groupBy("_chunk", *keys).agg(*(fold[k](c).alias(c) for c, k in columns.items()))
    earlier = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(
        "_chunk", *keys, *(fold[k](c).over(earlier).alias(f"_pre_{c}") for c, k in columns.items())
    )

    def combined(c: str, kind: str) -> Column:
        near, far = F.col(f"pre_{c}"), F.col(f"_pre_{c}")
        if kind == "sum":
            return F.coalesce(near + far, near, far)
        return F.least(near, far) if kind == "min" else F.greatest(near, far)

    return local.join(carried, ["_chunk", *keys]).select(
        *(c for c in df.columns if c != "_chunk"),
        *(combined(c, k).alias(f"pre_{c}") for c, k in columns.items()),
    )


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = 4096) -> float:
    """Exact quantile with linear interpolation between the two nearest values.

    Repeats a bounded histogram: each pass keeps only the bin that holds the
    wanted rank, so neither a task nor the driver ever holds all values. Every
    bin reports its own minimum and maximum, which ends the search as soon as
    the two neighbouring order statistics are bin borders.
    """
    x = df.select(F.col(column).cast("double").alias("x")).where("x is not null and not isnan(x)")
    total, low, high = x.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not total:
        raise ValueError(f"no values in column {column}")
    if not math.isfinite(low) or not math.isfinite(high):
        raise ValueError(f"infinite values in column {column}")
    position = (total - 1) * q
    lower_rank, part = math.floor(position), position - math.floor(position)
    lower = _order_statistics(x, lower_rank, low, high, bins, total)
    return lower[0] + (lower[1] - lower[0]) * part


def _order_statistics(
    x: DataFrame, rank: int, low: float, high: float, bins: int, total: int
) -> tuple[float, float]:
    """Values at 0-based ``rank`` and ``rank + 1`` (the last value repeats)."""
    if low == high:
        return low, low
    skipped = 0
    beyond = high  # smallest value known to lie above the current range
    while True:
        place = (F.col("x") - low) / (high - low)
        slot = F.least(F.floor(place * bins), F.lit(bins - 1))
        counted = (
            x.where(F.col("x").between(low, high))
            .groupBy(slot.alias("slot"))
            .agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        )
        rows = sorted(counted.collect(), key=lambda r: r["slot"])  # at most ``bins`` rows
        at = skipped
        for i, row in enumerate(rows):
            if rank < at + row["n"]:
                break
            at += row["n"]
        after = rows[i + 1]["low"] if i + 1 < len(rows) else beyond
        last = at + row["n"] - 1
        if row["low"] == row["high"]:
            return row["low"], (row["low"] if rank < last else after)
        if rank == last:
            return row["high"], (row["high"] if rank + 1 >= total else after)
        skipped, low, high, beyond = at, row["low"], row["high"], after
