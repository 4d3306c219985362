"""Risk scoring of an activity stream with Structured Streaming.

Spark's keyed state holds the statistics of every user: a micro-batch reads and writes
the state of its own users. What changed goes to tables below the output folder, each a
:class:`BatchLog`:

``users``    statistics of the users of each batch; of a user the newest row counts
``raws``     how many users gained or lost which raw risk, see ``levels``
``commits``  one row per batch, written last: metadata, calendar days so far, raw range
             and the number of users per cell of raw risks

Scores and levels follow from the statistics and the committed range when the result is
read, so a new extreme, or a new day that shifts the day-based rates, moves every user
without rewriting a row. For the level counts of the metadata a batch reads a few cells
of raw risks. Only when models are in use and a new day changes every user's features,
all raw risks are computed again.

Readers take the newest commit, so they never see a half-written batch. A replayed batch
starts from the commit before it, as Spark's state does, and overwrites its own folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskloom.functions import risk as fn
from riskloom.models.ensemble import Models, score_raw
from riskloom.operators.features import (
    FLAT_STATS,
    features_from_stats,
    stats_of_flat,
    totals_from_stats,
)
from riskloom.operators.report import score_stats
from riskloom.operators.risk import ranked, with_raw_risk
from riskloom.params import RiskParams
from riskloom.schemas import ACTIVITY_SCHEMA
from riskloom.sources.ship import ship_package
from riskloom.streaming.batch_log import BatchLog
from riskloom.streaming.levels import RAWS_SCHEMA, counted, level_counts, multiset
from riskloom.streaming.state import CHANGED_SCHEMA, changed_users
from riskloom.streaming.status import rows_observed, users_observed

# Column names of the batch metadata.
METADATA_COLS = [
    "batch_num",
    "total_batches",
    "users_in_batch",
    "total_users_processed",
    "timestamp",
    "high_risk_count",
    "critical_risk_count",
]


_COMMIT_SCHEMA = (
    "batch_id long, batch_num int, total_batches int, users_in_batch int, "
    "total_users_processed int, timestamp timestamp, high_risk_count long, "
    "critical_risk_count long, low double, high double, raws_read long, "
    "days array<int>, cells map<long, long>"
)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replay_source(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream the activity files of a folder: all that are new, or a few per micro-batch."""
    reader = spark.readStream.schema(ACTIVITY_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _newest(rows: DataFrame) -> DataFrame:
    """Of each user the row of the newest batch; what it was before matters no more."""
    rest = ["known", *FLAT_STATS, "batch_id"]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("newest")
    users = rows.groupBy("user_id").agg(newest).select("user_id", "newest.*")
    gone = {f"old_{c}": F.lit(None).cast(kind) for c, kind in FLAT_STATS.items()}
    return users.withColumns(gone | {"days": F.lit(None).cast("array<int>")})


def _only_metadata(commits: DataFrame) -> DataFrame:
    """Days and cells are read from the newest batch only, which is never merged away."""
    kinds = {"days": "array<int>", "cells": "map<long, long>"}
    return commits.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items()})


@dataclass
class RiskStream:
    """Scoring job over an output folder that all executors can reach."""

    spark: SparkSession
    folder: str
    params: RiskParams
    models: Models | None = None
    total_batches: int | None = None
    #: Batches after which a table's small folders are merged.
    keep: int = 32

    def __post_init__(self) -> None:
        def log(name, schema, merge):
            return BatchLog(self.spark, f"{self.folder}/{name}", schema, merge, self.keep)

        self.users = log("users", f"{CHANGED_SCHEMA}, batch_id long", _newest)
        self.raws = log("raws", RAWS_SCHEMA, multiset)
        self.commits = log("commits", _COMMIT_SCHEMA, _only_metadata)

    # Reading -----------------------------------------------------------------

    def last_commit(self, before: int | None = None) -> Row | None:
        last = self.commits.last(before)
        return None if last is None else self.commits.batch(last).first()

    def current_scores(self) -> DataFrame | None:
        """Every user seen so far, scored over all of them, highest risk first."""
        commit = self.last_commit()
        if commit is None:
            return None
        low, high = F.lit(commit["low"]).cast("double"), F.lit(commit["high"]).cast("double")
        score = fn.scale_to_100(F.col("risk_score_raw"), low, high)
        level = fn.risk_level(F.col("risk_score"), self.params)
        raw = self._raw(self._everyone(commit["batch_id"]), len(commit["days"]))
        return ranked(raw.withColumn("risk_score", score).withColumn("risk_level", level))

    def current_features(self) -> DataFrame | None:
        commit = self.last_commit()
        if commit is None:
            return None
        return features_from_stats(self._everyone(commit["batch_id"]), F.lit(len(commit["days"])))

    def current_stats(self) -> DataFrame | None:
        scores = self.current_scores()
        return None if scores is None else score_stats(scores)

    def metadata(self) -> DataFrame | None:
        """One row per micro-batch."""
        last = self.commits.last()
        return None if last is None else self.commits.rows(last).select(*METADATA_COLS)

    def _everyone(self, batch_id: int) -> DataFrame:
        return stats_of_flat(self.users.table(batch_id))

    def _raw(self, stats: DataFrame, n_days: int) -> DataFrame:
        """Raw risk of users; without models their features play no part."""
        if self.models is None:
            scored = totals_from_stats(stats)
        else:
            features = features_from_stats(stats, F.lit(n_days))
            scored = score_raw(features, self.models, mode="stream")
        return with_raw_risk(scored, self.params)

    # Writing -----------------------------------------------------------------

    def process(self, changed: DataFrame, batch_id: int) -> None:
        """Handle the changed users of one micro-batch; the ``foreachBatch`` function."""
        self.users.write(changed.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id)
        mine = self.users.batch(batch_id)  # the state is read and written once
        users, new = mine.agg(F.count(F.lit(1)), F.count_if(~F.col("known"))).first()
        if not users:
            return
        previous = self.last_commit(before=batch_id)
        days = set(previous["days"]) if previous else set()
        seen = mine.select(F.explode("days").alias("day")).distinct().collect()  # a calendar
        more_days = not {r["day"] for r in seen} <= days
        days |= {r["day"] for r in seen}
        self._write_raws(mine, previous, len(days), more_days, batch_id)

        cells = dict(previous["cells"]) if previous else {}
        moved = self.raws.batch(batch_id).groupBy("cell").agg(F.sum("n").alias("n"))
        for cell, n in moved.collect():  # bounded by the number of cells
            cells[cell] = cells.get(cell, 0) + n
        cells = {cell: n for cell, n in cells.items() if n}
        levels = level_counts(self.raws.rows(batch_id), cells, self.params)
        now = datetime.now()
        row = {
            "batch_id": batch_id,
            "batch_num": (previous["batch_num"] if previous else 0) + 1,
            "total_batches": self.total_batches,
            "users_in_batch": users,
            "total_users_processed": (previous["total_users_processed"] if previous else 0) + new,
            "timestamp": max(now, previous["timestamp"]) if previous else now,
            "high_risk_count": levels.users["High"],
            "critical_risk_count": levels.users["Critical"],
            "low": levels.low,
            "high": levels.high,
            "raws_read": levels.rows_read,
            "days": sorted(days),
            "cells": cells,
        }
        commit = self.spark.createDataFrame([tuple(row.values())], _COMMIT_SCHEMA)
        self.commits.write(commit.coalesce(1), batch_id)
        for table in (self.users, self.raws, self.commits):
            table.compact(batch_id)

    def _write_raws(
        self, mine: DataFrame, previous: Row | None, n_days: int, more_days: bool, batch_id: int
    ) -> None:
        """Store which raw risks the batch takes away and which it adds."""
        if self.models is not None and more_days and previous is not None:
            after = self._everyone(batch_id)  # day-based rates of everyone change
            gone = self.raws.table(batch_id - 1).withColumn("n", -F.col("n"))
        else:
            after = stats_of_flat(mine)
            before = stats_of_flat(mine.where("known"), "old_")
            gone = counted(self._raw(before, n_days), -1)
        come = counted(self._raw(after, n_days), 1)
        self.raws.write(multiset(come.unionByName(gone)), batch_id)

    def start(self, source: DataFrame, available_now: bool = False) -> StreamingQuery:
        """Run over a stream of activity rows, at the configured interval by default.

        State lies in RocksDB, with the checkpoint below the output folder; the session's own
        choice of a state store stays as it is.
        """
        ship_package(self.spark)
        changed = changed_users(rows_observed(source, self.folder))
        writer = (
            users_observed(changed, self.folder)
            .writeStream.outputMode("update")
            .foreachBatch(self.process)
            .option("checkpointLocation", f"{self.folder}/checkpoint")
        )
        every = {"processingTime": f"{self.params.interval_seconds} seconds"}
        writer = writer.trigger(**({"availableNow": True} if available_now else every))
        before = self.spark.conf.get(_PROVIDER)
        self.spark.conf.set(_PROVIDER, _ROCKSDB)
        try:
            return writer.start()
        finally:
            self.spark.conf.set(_PROVIDER, before)
