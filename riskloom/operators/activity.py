"""Roll raw events up to the activity log: one row per user and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import ACTIVITY_SCHEMA

# Day 0 is a Monday, so day indexes 5 and 6 of a week are the weekend.
EPOCH_DAY = "2024-01-01"


def day_index(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit(EPOCH_DAY).cast("date"))


def is_weekend(day: Column) -> Column:
    return (F.pmod(day, F.lit(7)) >= 5).cast("int")


def daily_measures() -> list[Column]:
    """Aggregates of one user-day of events; all numeric, so they hash-aggregate."""
    kind, hour = F.col("event_type"), F.hour("ts")
    # In Spark NaN is above every number; here it is a missing value.
    large = F.coalesce((F.col("value") > 100) & ~F.isnan("value"), F.lit(False))
    return [
        F.min(hour).alias("login_hour"),
        F.count_if(kind == "view").alias("files_accessed"),
        F.count_if(kind == "error").alias("failed_logins"),
        F.count_if(kind == "purchase").alias("sensitive_files"),
        F.count_if(kind == "click").alias("emails_sent"),
        F.max(large.cast("int")).alias("usb_usage"),
        F.count_if((hour < 6) | (hour >= 20)).alias("after_hours"),
        F.max((kind == "signup").cast("int")).alias("vpn_connections"),
    ]


def roles_of(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("role")
    )


def daily_activity(events: DataFrame, roles: DataFrame) -> DataFrame:
    """Activity log of all users; ``roles`` (``user_id``, ``role``) has one row each.

    A user that ``roles`` does not know has a NULL role.

    Events are aggregated before the join: a user with a huge share of all
    events shrinks to one row per day and map task before anything is shuffled,
    and the join moves user-days instead of events.
    """
    days = (
        events.where(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("user_id", day_index(F.col("ts")).alias("day"))
        .agg(*daily_measures())
    )
    return (
        days.join(roles, "user_id", "left")
        .withColumn("is_weekend", is_weekend(F.col("day")))
        .select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in ACTIVITY_SCHEMA))
    )


def for_users(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Activity of a set of users (one ``user_id`` column)."""
    return activity.join(users.select("user_id"), "user_id", "left_semi")
