"""Exact counts of risk levels while the range of raw risks moves.

Raw risks are kept as a multiset: how many users have which value, in cells of values
that lie within 1.6 % of each other. Multisets merge by addition, a user who changes
takes one value out and puts one in. A level begins at a share of the range, so it cuts
one cell; all other cells lie on one side as a whole, and only rows of the cells at the
ends of the range and at the borders of levels are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import risk as fn
from riskloom.params import RiskParams
from riskloom.schemas import RISK_LEVELS

#: Cells for a factor of e; doubles span 1,455 such factors on each side of 0.
_STEPS = 64
_BEYOND = 750 * _STEPS
_INFINITE = 10 * _BEYOND
RAWS_SCHEMA = "cell long, raw double, n long"


def cell_of(raw: Column) -> Column:
    """Number of the cell of a raw risk, rising with it; NULL for NULL and NaN."""
    size = F.abs(raw)
    place = F.when(size == float("inf"), F.lit(_INFINITE).cast("long")).otherwise(
        F.floor(F.log(size) * _STEPS) + _BEYOND
    )
    return F.when(raw == 0, F.lit(0).cast("long")).when(raw > 0, place).when(raw < 0, -place)


def _cell(raw: float) -> int:
    if raw == 0:
        return 0
    place = math.floor(math.log(abs(raw)) * _STEPS) + _BEYOND
    return place if raw > 0 else -place


def multiset(rows: DataFrame) -> DataFrame:
    """Sum up (cell, raw, n); what cancels out goes. Sorted by cell, which scans then skip by."""
    summed = rows.where("cell IS NOT NULL").groupBy("cell", "raw").agg(F.sum("n").alias("n"))
    return summed.where("n <> 0").sortWithinPartitions("cell")


def counted(raw: DataFrame, sign: int) -> DataFrame:
    """Rows of a multiset for a column ``risk_score_raw``, to be added or taken away."""
    value = fn.without_nan(F.col("risk_score_raw"))
    return raw.select(
        cell_of(value).alias("cell"), value.alias("raw"), F.lit(sign).cast("long").alias("n")
    )


@dataclass(frozen=True)
class LevelCounts:
    """``rows_read`` rows of the multiset were read to find the rest."""

    low: float | None
    high: float | None
    users: dict[str, int]
    rows_read: int


def level_counts(raws: DataFrame, cells: dict[int, int], params: RiskParams) -> LevelCounts:
    """Range of all raw risks, and how many of them are in each level.

    ``cells`` has the number of users in each cell, ``raws`` the rows that sum up to the
    multiset. An infinite end of the range scales unevenly; then all rows are read.
    """
    taken = sorted(c for c, n in cells.items() if n)
    if not taken:
        return LevelCounts(None, None, dict.fromkeys(RISK_LEVELS, 0), 0)
    ends = multiset(raws.where(F.col("cell").isin(taken[0], taken[-1])))
    low, high, read = ends.agg(F.min("raw"), F.max("raw"), F.count(F.lit(1))).first()
    shares = {"Critical": params.critical, "High": params.high, "Medium": params.medium}
    if low == high or not (math.isfinite(low) and math.isfinite(high)):
        exact, borders = taken, {}
    else:
        # Scores and cells are rounded, so a border is a narrow range of cells.
        width = high - low
        slack = 1e-12 * (abs(low) + abs(high))
        starts = {lv: low + share / 100 * width for lv, share in shares.items()}
        borders = {lv: (_cell(t - slack) - 1, _cell(t + slack) + 1) for lv, t in starts.items()}
        exact = [c for c in taken if any(a <= c <= b for a, b in borders.values())]
    users = dict.fromkeys(RISK_LEVELS, 0)
    if exact:
        score = fn.scale_to_100(F.col("raw"), F.lit(low), F.lit(high))
        rows = multiset(raws.where(F.col("cell").isin(exact)))
        found = rows.withColumn("level", fn.risk_level(score, params)).groupBy("level")
        for level, n, lines in found.agg(F.sum("n"), F.count(F.lit(1))).collect():
            users[level] += n
            read += lines
    for c in set(taken) - set(exact):
        level = next((lv for lv, (_, end) in borders.items() if c > end), "Low")
        users[level] += cells[c]
    return LevelCounts(low, high, users, read)
