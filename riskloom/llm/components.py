"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.staging import stage


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    mixed = F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1))
    n, mark = edges.agg(F.count(F.lit(1)), F.sum(mixed)).first()
    return n, mark or 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of the edges ``u``, ``v``.

    Alternates large-star and small-star rounds until the edges stay as they are,
    which takes a few rounds, growing with the logarithm of the longest chain. Each
    round is a map-side combined minimum and a join; its edges are written to the
    shared folder. Only a row count and a check sum come to the driver. Self-loops
    and NULL ends are ignored; no edges give no rows.
    """
    current = stage(
        edges.where("u is not null and v is not null and u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _fingerprint(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.join(low, "u")
            .where("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        current = stage(small, "edges")
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
