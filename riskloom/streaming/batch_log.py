"""Tables that the micro-batches of a stream write, one folder each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskloom.sources.tables import delete_path, hadoop_path


class BatchLog:
    """Rows by micro-batch, below one folder that all executors can reach.

    ``batch=N`` holds what batch N wrote; a replayed batch overwrites its own folder.
    After ``keep`` batches they are merged into ``upto=N``, by a function that gives the
    same table from all rows as from a merged part and the rest. Merged batches stay
    until the next merge, for readers that are still on them, so a log has two merged
    tables and twice ``keep`` batches at most.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: str | StructType,
        merge: Callable[[DataFrame], DataFrame],
        keep: int = 32,
    ):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.merge, self.keep = merge, keep

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind, ascending; a listing, no file is read."""
        fs, target = hadoop_path(self.spark, self.folder)
        if not fs.exists(target):
            return []
        found = []
        for status in fs.listStatus(target):
            name = status.getPath().getName()
            _, done = hadoop_path(self.spark, f"{self.folder}/{name}/_SUCCESS")
            if name.startswith(f"{kind}=") and fs.exists(done):
                found.append(int(name.split("=")[1]))
        return sorted(found)

    def last(self, before: int | None = None) -> int | None:
        """The newest batch, or the newest before a given one."""
        found = [i for i in self._numbers("batch") if before is None or i < before]
        return found[-1] if found else None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def batch(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/batch={batch_id}")

    def _merged(self, upto: int) -> int:
        return max((i for i in self._numbers("upto") if i <= upto), default=-1)

    def rows(self, upto: int) -> DataFrame:
        """Everything that the batches up to a given one wrote, merged rows among it."""
        merged = self._merged(upto)
        paths = [f"{self.folder}/upto={merged}"] if merged >= 0 else []
        later = (i for i in self._numbers("batch") if merged < i <= upto)
        paths += [f"{self.folder}/batch={i}" for i in later]
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def table(self, upto: int) -> DataFrame:
        return self.merge(self.rows(upto))

    def compact(self, upto: int) -> None:
        """Merge the batches up to a committed one, if they are ``keep`` or more by now."""
        merged = self._merged(upto)
        batches = [i for i in self._numbers("batch") if i <= upto]
        if len([i for i in batches if i > merged]) < self.keep:
            return
        self.table(upto).write.mode("overwrite").parquet(f"{self.folder}/upto={upto}")
        gone = [f"batch={i}" for i in batches if i <= merged and i != batches[-1]]
        gone += [f"upto={i}" for i in self._numbers("upto") if i < merged]
        for name in gone:
            delete_path(self.spark, f"{self.folder}/{name}")
