"""Daily roll-up of an event stream: the activity log as a streaming table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from riskloom.operators.activity import daily_measures, day_index, is_weekend
from riskloom.schemas import ACTIVITY_SCHEMA
from riskloom.streaming.batch_log import BatchLog


def daily_activity_stream(events: DataFrame, roles: DataFrame, late: str = "1 day") -> DataFrame:
    """Activity rows of a stream of events.

    In append mode a day is emitted once, when the watermark passes its end; in update
    mode it is emitted again whenever it changes, also while it is open. Events later
    than ``late`` behind the newest one are dropped.
    """
    days = (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .where("user_id is not null")
        .withWatermark("ts", late)
        .groupBy(F.window("ts", "1 day"), "user_id")
        .agg(*daily_measures())
    )
    return (
        days.withColumn("day", day_index(F.col("window.start")))
        .join(roles, "user_id", "left")
        .withColumn("is_weekend", is_weekend(F.col("day")))
        .select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in ACTIVITY_SCHEMA))
    )


_DAYS = T.StructType([*ACTIVITY_SCHEMA, T.StructField("batch_id", T.LongType())])


def _newest(rows: DataFrame) -> DataFrame:
    """Of each user-day the state of the newest batch."""
    rest = [f.name for f in _DAYS if f.name not in ("user_id", "day")]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("newest")
    states = rows.groupBy("user_id", "day").agg(newest)
    return states.select("user_id", "day", "newest.*").select(*(f.name for f in _DAYS))


def _log(spark: SparkSession, folder: str) -> BatchLog:
    return BatchLog(spark, f"{folder}/days", _DAYS, _newest)


def start_roll_up(
    events: DataFrame, roles: DataFrame, folder: str, late: str = "1 day"
) -> StreamingQuery:
    """Keep the newest state of every user-day below ``folder``, open days included.

    Each micro-batch writes the user-days it changed to a folder of its own, so a
    replayed batch overwrites itself; superseded states go when folders are merged. Runs
    until the source has no more data.
    """
    days = daily_activity_stream(events, roles, late)
    log = _log(events.sparkSession, folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id)
        log.compact(batch_id)

    return (
        days.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def rolled_up(spark: SparkSession, folder: str) -> DataFrame:
    """The activity log that :func:`start_roll_up` has written so far."""
    log = _log(spark, folder)
    last = log.last()
    return log.table(-1 if last is None else last).select(*(f.name for f in ACTIVITY_SCHEMA))
