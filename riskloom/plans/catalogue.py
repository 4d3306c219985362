"""The registered queries: every operator over the whole of the given tables.

Unless a model is named, risk is rule-only: raw totals, absent model scores 0.
Doubles are rounded to 6 digits so that engines compare equal.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.models.ensemble import (
    Models,
    fit_models,
    inventory,
    load_models,
    save_models,
    score_scaled,
)
from riskloom.models.isolation_forest import NODE_SCHEMA
from riskloom.operators import batches, features, report, risk, scaling
from riskloom.operators.activity import daily_activity, for_users, roles_of
from riskloom.operators.upsert import upsert
from riskloom.params import RiskParams
from riskloom.plans import pipeline
from riskloom.schemas import CUSTOMER_SCHEMA, EVENT_SCHEMA
from riskloom.sources.ship import ship_package
from riskloom.sources.staging import new_path, stage
from riskloom.sources.tables import (
    load_or_compute,
    read_activity,
    rejected_activity,
    write_alerts_csv,
)
from riskloom.streaming.daily import rolled_up, start_roll_up
from riskloom.streaming.job import RiskStream, replay_source
from riskloom.streaming.status import LiveStatus

PARAMS = RiskParams()
#: Micro-batches of the replayed streams.
REPLAY_PARTS = 4
ROWS_PER_FILE = 250_000
#: Added to user ids: doubles do not tell odd numbers beyond it from even ones.
BEYOND_DOUBLES = 2**53
#: Last day of the earlier log state that ``upsert_scores`` starts from.
EARLIER_DAY = 14

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    _QUERIES[query.__name__] = query
    return query


def catalogue() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 digits, never a negative zero."""

    def column(f: T.StructField):
        if not isinstance(f.dataType, T.DoubleType):
            return F.col(f.name)
        value = F.round(f.name, 6)
        return F.when(value == 0, F.lit(0.0)).otherwise(value).alias(f.name)

    return df.select(*(column(f) for f in df.schema))


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CUSTOMER_SCHEMA).parquet(f"{sf_dir}/customer.parquet")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return daily_activity(events, roles_of(_customer(spark, sf_dir)))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.rules_only_scored(activity(spark, sf_dir), PARAMS)


def _fitted(
    spark: SparkSession, sf_dir: str, *which: str
) -> tuple[Models, DataFrame]:
    ship_package(spark)
    raw_features = features.user_features(activity(spark, sf_dir))
    return fit_models(raw_features, PARAMS, which) if which else fit_models(raw_features, PARAMS)


# Activity and features ------------------------------------------------------


@_register
def n_days(spark, sf_dir):
    return features.distinct_days(activity(spark, sf_dir))


@_register
def weekend_profile(spark, sf_dir):
    return rounded(features.day_kind_means(features.user_stats(activity(spark, sf_dir))))


@_register
def user_features(spark, sf_dir):
    return rounded(features.user_features(activity(spark, sf_dir)))


@_register
def features_for_users(spark, sf_dir):
    """Features of a watch list: the customers in debt."""
    debtors = _customer(spark, sf_dir).where("c_acctbal < 0")
    log = for_users(activity(spark, sf_dir), debtors.withColumnRenamed("c_custkey", "user_id"))
    return rounded(features.user_features(log))


@_register
def scaler_stats(spark, sf_dir):
    return rounded(scaling.fit_scaler(features.user_features(activity(spark, sf_dir))))


@_register
def features_scaled(spark, sf_dir):
    table = stage(features.user_features(activity(spark, sf_dir)), "features")
    return rounded(scaling.scale(table).drop("role"))


# Risk -----------------------------------------------------------------------


@_register
def risk_rules_only(spark, sf_dir):
    return rounded(pipeline.rules_only_raw(activity(spark, sf_dir), PARAMS))


@_register
def risk_scored(spark, sf_dir):
    return rounded(_scored(spark, sf_dir))


@_register
def risk_ranked(spark, sf_dir):
    return rounded(risk.ranked(_scored(spark, sf_dir)))


@_register
def top_risky_users(spark, sf_dir):
    return rounded(report.top_risky(_scored(spark, sf_dir)))


@_register
def risk_breakdown(spark, sf_dir):
    return risk.breakdown(_scored(spark, sf_dir), PARAMS)


# Reports --------------------------------------------------------------------


@_register
def risk_level_counts(spark, sf_dir):
    return report.level_counts(_scored(spark, sf_dir))


@_register
def risk_level_share(spark, sf_dir):
    return rounded(report.level_shares(_scored(spark, sf_dir)))


@_register
def risk_stats(spark, sf_dir):
    return rounded(report.score_stats(_scored(spark, sf_dir)))


@_register
def kpi(spark, sf_dir):
    return report.kpis(_scored(spark, sf_dir))


@_register
def critical_alarm(spark, sf_dir):
    return report.critical_alarm(_scored(spark, sf_dir))


@_register
def distinct_roles(spark, sf_dir):
    return report.distinct_values(activity(spark, sf_dir), "role")


@_register
def role_level_crosstab(spark, sf_dir):
    return report.role_level_crosstab(_scored(spark, sf_dir))


@_register
def score_histogram(spark, sf_dir):
    return report.score_histogram(_scored(spark, sf_dir))


@_register
def filtered_view(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    view = report.filter_scored(
        scored, levels=["Critical", "High"], low=30, high=90, roles=["BUILDING", "MACHINERY"]
    )
    return rounded(view)


@_register
def alert_table(spark, sf_dir):
    return report.alert_table(_scored(spark, sf_dir))


@_register
def alerts_export(spark, sf_dir):
    """Critical and High users, through the CSV export and back."""
    alerts = report.alerts(_scored(spark, sf_dir))
    path = new_path(spark, "alerts")
    write_alerts_csv(alerts, path)
    return rounded(spark.read.schema(alerts.schema).csv(path, header=True))


@_register
def user_cards(spark, sf_dir):
    return report.user_cards(_scored(spark, sf_dir))


@_register
def user_drilldown(spark, sf_dir):
    """The card of the riskiest user."""
    return report.user_cards(risk.ranked(_scored(spark, sf_dir)).limit(1))


@_register
def user_breakdown(spark, sf_dir):
    """Point lookup of a user, the one with the smallest id: factors by falling share."""
    scored = stage(_scored(spark, sf_dir), "scored")
    user = scored.agg(F.min("user_id")).first()[0]
    return risk.breakdown_of(scored, user, PARAMS)


@_register
def behaviour_profile(spark, sf_dir):
    return rounded(report.behaviour_profile(features.user_features(activity(spark, sf_dir))))


@_register
def stored_scores(spark, sf_dir):
    """The stored scored table, computed and written on the first request."""
    path = new_path(spark, "scored")
    tables = [f"{sf_dir}/{name}.parquet" for name in ("events", "customer")]
    load_or_compute(spark, path, lambda: _scored(spark, sf_dir), *tables)
    return rounded(load_or_compute(spark, path, lambda: _scored(spark, sf_dir), *tables))


def _csv_log(spark: SparkSession, sf_dir: str) -> str:
    """The activity log as CSV, columns from the last to the first.

    Users have ids that only exact reading tells apart, and files are counted in halves.
    """
    path = new_path(spark, "activity-csv")
    log = activity(spark, sf_dir).withColumns(
        {
            "user_id": F.col("user_id") + BEYOND_DOUBLES,
            "files_accessed": (F.col("files_accessed") / 2).cast("decimal(20,1)"),
        }
    )
    log.select(*log.columns[::-1]).write.csv(path, header=True)
    return path


@_register
def csv_activity(spark, sf_dir):
    """The activity log read back from CSV, without the rows that have half a file."""
    return read_activity(spark, _csv_log(spark, sf_dir), "csv")


@_register
def csv_rejects(spark, sf_dir):
    """The lines of the CSV that are no rows, by what is wrong with them."""
    rejected = rejected_activity(spark, _csv_log(spark, sf_dir))
    return rejected.select(
        F.element_at(F.split("record", ","), -1).cast("long").alias("user_id"),
        F.array_join("reasons", ",").alias("reasons"),
    )


# Batches and upserts --------------------------------------------------------


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    raw = pipeline.rules_only_raw(activity(spark, sf_dir), PARAMS)
    return batches.batch_metadata(raw, PARAMS.batch_size, PARAMS)


@_register
def user_batches(spark, sf_dir):
    users = activity(spark, sf_dir).select("user_id").distinct()
    return batches.user_batches(users, PARAMS.batch_size)


@_register
def batch_metadata(spark, sf_dir):
    return _metadata(spark, sf_dir)


@_register
def batch_metadata_latest(spark, sf_dir):
    return batches.latest_metadata(_metadata(spark, sf_dir))


@_register
def batch_progress(spark, sf_dir):
    return rounded(batches.batch_progress(_metadata(spark, sf_dir), PARAMS.batch_size))


@_register
def batch_clock(spark, sf_dir):
    """Status line per replay batch, stamped with the last event of the batch's users."""
    events = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    last = events.groupBy("user_id").agg(F.max("ts").alias("ts"))
    users = activity(spark, sf_dir).select("user_id").distinct()
    stamps = (
        batches.user_batches(users, PARAMS.batch_size)
        .join(last, "user_id")
        .groupBy("batch_num")
        .agg(F.max("ts").cast("timestamp").alias("timestamp"))
    )
    stamped = _metadata(spark, sf_dir).join(stamps, "batch_num")
    return rounded(batches.batch_progress(stamped, PARAMS.batch_size))


@_register
def upsert_scores(spark, sf_dir):
    """Scores as of an earlier day, updated with the users active on the last day."""
    log = stage(activity(spark, sf_dir), "activity")
    last_day = log.agg(F.max("day")).scalar()
    active = log.where(F.col("day") == last_day).select("user_id").distinct()
    old = pipeline.rules_only_raw(log.where(F.col("day") <= EARLIER_DAY), PARAMS)
    new = pipeline.rules_only_raw(for_users(log, active), PARAMS)
    return rounded(risk.with_levels(stage(upsert(old, new), "upserted"), PARAMS))


# Models ---------------------------------------------------------------------


@_register
def iforest_nodes(spark, sf_dir):
    models, _ = _fitted(spark, sf_dir, "forest")
    return rounded(spark.createDataFrame(models.forest.nodes, NODE_SCHEMA))


@_register
def iforest_scores(spark, sf_dir):
    models, scaled = _fitted(spark, sf_dir, "forest")
    scored = score_scaled(scaled, models)
    return rounded(
        scored.select(
            "user_id",
            (-F.col("if_score")).alias("score_samples"),
            (-F.col("if_score") - models.forest.offset).alias("decision"),
        )
    )


@_register
def ocsvm_scores(spark, sf_dir):
    models, scaled = _fitted(spark, sf_dir, "svm")
    return score_scaled(scaled, models).select("user_id", (-F.col("svm_score")).alias("decision"))


@_register
def ae_scores(spark, sf_dir):
    models, scaled = _fitted(spark, sf_dir, "autoencoder")
    return score_scaled(scaled, models).select("user_id", "ae_score")


def _ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    models, scaled = _fitted(spark, sf_dir)
    return pipeline.score_batch(scaled, models, PARAMS)


@_register
def ensemble_scores(spark, sf_dir):
    return _ensemble(spark, sf_dir)


@_register
def model_score_means(spark, sf_dir):
    return report.model_score_means(_ensemble(spark, sf_dir))


@_register
def model_pair_view(spark, sf_dir):
    return report.model_pair_view(report.filter_scored(_ensemble(spark, sf_dir)))


@_register
def score_requests(spark, sf_dir):
    models, _ = _fitted(spark, sf_dir)
    requests = features.user_features(activity(spark, sf_dir))
    return pipeline.score_requests(requests, models, PARAMS)


@_register
def stored_model_scores(spark, sf_dir):
    """Models saved, loaded and applied; the autoencoder was never stored and scores 0."""
    models, _ = _fitted(spark, sf_dir, "forest", "svm")
    folder = new_path(spark, "models")
    save_models(spark, models, folder)
    requests = features.user_features(activity(spark, sf_dir))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        loaded = load_models(spark, folder)
    return pipeline.score_requests(requests, loaded, PARAMS)


@_register
def model_inventory(spark, sf_dir):
    """The tables of a stored set of models; the forest's rows are given by their bound."""
    models, _ = _fitted(spark, sf_dir, "forest", "svm")
    folder = new_path(spark, "models")
    save_models(spark, models, folder)
    most = 2 * PARAMS.forest.trees * PARAMS.forest.max_samples
    grown = F.col("table") == "iforest_nodes"
    return inventory(spark, folder).select(
        F.col("table").alias("model_table"),
        F.when(~grown, F.col("rows")).alias("rows"),
        F.when(grown, F.col("rows").between(PARAMS.forest.trees, most)).alias("in_bounds"),
    )


@_register
def model_facts(spark, sf_dir):
    """What the fitted models must satisfy, in numbers that follow from the tables alone.

    Users scored; users below the forest's offset; users clearly below the SVM's border;
    the SVM's gamma; users without an autoencoder error; users whose risk is not the
    weighted sum of its terms.
    """
    models, scaled = _fitted(spark, sf_dir)
    scored = pipeline.score_batch(scaled, models, PARAMS)
    terms = [F.lit(w) * F.col(c) for c, w in PARAMS.weights.items()]
    off = F.abs(F.col("risk_score_raw") - sum(terms[1:], terms[0])) > 1e-9
    return rounded(
        scored.agg(
            F.count(F.lit(1)).alias("users"),
            F.count_if(F.col("if_score") > 0).alias("below_offset"),
            (F.count_if(F.col("svm_score") > 1e-3) <= PARAMS.svm.nu * F.count(F.lit(1))).alias(
                "few_outside"
            ),
            F.lit(models.svm.gamma).alias("gamma"),
            F.count_if(F.col("ae_score").isNull() | (F.col("ae_score") < 0)).alias("without_error"),
            F.count_if(off).alias("wrong_risk"),
            F.max("risk_score").alias("highest"),
            F.min("risk_score").alias("lowest"),
        )
    )


# Streams --------------------------------------------------------------------


def _replay(spark: SparkSession, sf_dir: str, models: Models | None = None):
    """A stream and the whole activity log as its source, split by user into parts in order.

    Every part has the same number of files, which is a micro-batch; more with more rows.
    """
    ship_package(spark)
    source = new_path(spark, "replay")
    log = stage(activity(spark, sf_dir), "activity")
    log = log.withColumn("part", F.pmod("user_id", F.lit(REPLAY_PARTS)))
    smallest = log.groupBy("part").count().agg(F.min("count")).first()[0] or 0
    # Rows are dealt in turn, so no file is empty if some input partition has a row for each.
    files = max(1, smallest // max(ROWS_PER_FILE, log.rdd.getNumPartitions()))
    for part in range(REPLAY_PARTS):
        rows = log.where(F.col("part") == part).drop("part")
        rows.repartition(files).write.mode("append").parquet(source)
    job = RiskStream(
        spark, new_path(spark, "stream"), PARAMS, models, total_batches=REPLAY_PARTS
    )
    return job, replay_source(spark, source, files)


def _replayed(spark: SparkSession, sf_dir: str, models: Models | None = None) -> RiskStream:
    job, source = _replay(spark, sf_dir, models)
    job.start(source, available_now=True).awaitTermination()
    return job


@_register
def stream_scored(spark, sf_dir):
    return rounded(_replayed(spark, sf_dir).current_scores())


@_register
def stream_features(spark, sf_dir):
    return rounded(_replayed(spark, sf_dir).current_features())


@_register
def stream_ensemble(spark, sf_dir):
    models, _ = _fitted(spark, sf_dir)
    return _replayed(spark, sf_dir, models).current_scores()


@_register
def stream_metadata(spark, sf_dir):
    return _replayed(spark, sf_dir).metadata().drop("timestamp")


@_register
def stream_status(spark, sf_dir):
    """What a listener saw of the replay while it ran."""
    job, source = _replay(spark, sf_dir)
    status = LiveStatus(job)
    spark.streams.addListener(status)
    try:
        job.start(source, available_now=True).awaitTermination()
        if not status.wait(120):
            raise TimeoutError("the stream ended without its last report")
    finally:
        spark.streams.removeListener(status)
    return rounded(status.table().drop("updated"))


@_register
def stream_daily_activity(spark, sf_dir):
    """The activity log from the event stream, up to the end of its input."""
    folder = new_path(spark, "daily")
    reader = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events.parquet")
    start_roll_up(
        reader.parquet(sf_dir), roles_of(_customer(spark, sf_dir)), folder
    ).awaitTermination()
    return rolled_up(spark, folder)


_QUERIES["daily_activity"] = activity
