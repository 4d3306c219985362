"""Arrow <-> numpy helpers and sums over shards, shared by the three models."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PART = "shard int, v binary"  # a vector of doubles as bytes


def _add(parts: Iterable[bytes]) -> np.ndarray:
    return np.sum([np.frombuffer(p) for p in parts], axis=0)


def to_matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Rows x columns float matrix of an Arrow batch."""
    parts = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
    return np.column_stack(parts).astype(float, copy=False)


def sharded(df: DataFrame, columns: list[str], shards: int) -> DataFrame:
    """(user_id, x): feature vectors, one partition per shard with a fixed row order.

    The shard of a row depends on its user only, so a fit gives the same result
    on any cluster. The rows are kept for repeated passes; ``df`` should be a
    stored table, from which lost blocks are read again.
    """
    vectors = df.select("user_id", F.array(*columns).alias("x"))
    return vectors.repartition(shards, "user_id").sortWithinPartitions("user_id").persist()


def vectors_of(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    """Rows x features matrix of an array column."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1).astype(float, copy=False)


def sum_over_shards(
    data: DataFrame,
    shards: int,
    per_shard: Callable[[Iterator[np.ndarray]], np.ndarray | None],
    fan_in: int = 64,
) -> np.ndarray:
    """Sum of one vector per partition of :func:`sharded` data, in a fixed order.

    The vectors have a length fixed by the model, not by the data. They are added
    in groups of at most ``fan_in``, in as many levels as it takes until no more
    than that many are left for the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vector = per_shard(vectors_of(b) for b in batches if b.num_rows)
        if vector is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int32()),
                    pa.array([vector.astype(float).tobytes()], pa.binary()),
                ],
                names=["shard", "v"],
            )

    parts = data.select("x").mapInArrow(run, _PART)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("shard")
        number = group["shard"].iloc[0] // fan_in
        return pd.DataFrame({"shard": [number], "v": [_add(group["v"]).tobytes()]})

    while shards > fan_in:
        parts = parts.groupBy(F.floor(F.col("shard") / fan_in)).applyInPandas(add, _PART)
        shards = -(-shards // fan_in)
    rows = sorted(parts.collect(), key=lambda r: r["shard"])
    return _add(r["v"] for r in rows)
