"""Upsert of scored rows."""

from pyspark.sql import DataFrame


def upsert(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` plus the users of ``state`` that it does not contain."""
    kept = state.join(batch.select("user_id"), "user_id", "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)
