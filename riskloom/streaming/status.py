"""Status of a running scoring stream, from what Spark reports of each micro-batch."""

from __future__ import annotations

import threading
from collections import deque
from dataclasses import dataclass
from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

if TYPE_CHECKING:
    from riskloom.streaming.job import RiskStream

STATUS_SCHEMA = (
    "batch_num int, total_batches int, rows_in_batch long, users_in_batch long, "
    "users_so_far long, progress double, updated timestamp"
)


def _row_metric(folder: str) -> str:
    return f"rows for {folder}"


def _user_metric(folder: str) -> str:
    return f"users for {folder}"


def rows_observed(source: DataFrame, folder: str) -> DataFrame:
    """Let a stream of activity rows count them as they pass; rows without a user do not count."""
    return source.observe(_row_metric(folder), F.count("user_id").alias("n"))


def users_observed(changed: DataFrame, folder: str) -> DataFrame:
    """Let a stream of changed users count them, and those among them that are new."""
    new = F.count_if(~F.col("known")).alias("new")
    return changed.observe(_user_metric(folder), F.count(F.lit(1)).alias("n"), new)


@dataclass(frozen=True)
class _Batch:
    batch_id: int
    rows: int
    users: int
    new: int
    updated: datetime


class LiveStatus(StreamingQueryListener):
    """Follows a :class:`RiskStream` while it runs, without a job or a read of its own.

    Register it with ``spark.streams.addListener`` before the job starts. The counts are
    measured inside the micro-batches; other streams of the session are passed over, and
    so are micro-batches without users, which have no number. After a restart the number
    of batches and users goes on from the last commit before the first batch seen. The
    newest ``keep`` batches are listed.
    """

    def __init__(self, job: RiskStream, keep: int = 1000) -> None:
        self.job, self.keep = job, keep
        self._lock, self._ended = threading.Lock(), threading.Event()
        self._batches: deque[_Batch] = deque()
        self._first: int | None = None
        self._left_out = self._left_out_new = 0
        self._run: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        users = progress.observedMetrics.get(_user_metric(self.job.folder))
        if users is None:
            return
        self._run = str(progress.runId)
        rows = progress.observedMetrics.get(_row_metric(self.job.folder))
        if not users["n"]:
            return
        at = datetime.fromisoformat(progress.timestamp)
        with self._lock:
            if self._first is None:
                self._first = progress.batchId
            elif self._batches and at < self._batches[-1].updated:
                at = self._batches[-1].updated  # a clock set back
            batch = _Batch(progress.batchId, rows["n"] if rows else 0, users["n"], users["new"], at)
            self._batches.append(batch)
            if len(self._batches) > self.keep:
                gone = self._batches.popleft()
                self._left_out += 1
                self._left_out_new += gone.new

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._ended.set()

    def wait(self, seconds: float) -> bool:
        """Wait until the last report of a stream that has ended is in."""
        return self._ended.wait(seconds)

    def table(self) -> DataFrame:
        """One row per micro-batch seen, as :data:`STATUS_SCHEMA`; at most ``keep`` rows.

        ``progress`` is the share of the planned batches that is done, null without a plan.
        """
        with self._lock:
            batches, first = list(self._batches), self._first
            number, so_far = self._left_out, self._left_out_new
        commit = None if first is None else self.job.last_commit(before=first)
        if commit is not None:
            number += commit["batch_num"]
            so_far += commit["total_users_processed"]
        total, out = self.job.total_batches, []
        for b in batches:
            number, so_far = number + 1, so_far + b.new
            share = min(number / total, 1.0) if total else None
            out.append((number, total, b.rows, b.users, so_far, share, b.updated))
        return self.job.spark.createDataFrame(out, STATUS_SCHEMA)
