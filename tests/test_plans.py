"""Physical plans that must hold at any scale."""

import pytest

from riskloom.operators import report, risk
from riskloom.operators.features import risk_totals, user_features, user_stats
from riskloom.params import RiskParams
from riskloom.plans import catalogue, pipeline

P = RiskParams()
SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plan the joins as they are planned for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_events_are_aggregated_before_the_join(spark, no_broadcast):
    text = plan(catalogue.activity(spark, SF))
    assert text.index("SortMergeJoin") < text.index("HashAggregate")
    assert "SortAggregate" not in text
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(user_id)]" in text
    assert "props" not in text and "event_id" not in text  # unused columns are not read


def test_user_aggregates_reuse_the_join_partitioning(spark, no_broadcast):
    text = plan(risk_totals(catalogue.activity(spark, SF)))
    # One exchange for user-days, then one per join side; none for the two user aggregates.
    assert text.count("Exchange hashpartitioning") == 3


def test_features_read_the_activity_once(spark, no_broadcast):
    text = plan(user_stats(catalogue.activity(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 3
    assert "Scan" not in plan(user_features(catalogue.activity(spark, SF))).replace("Scan parquet", "", 1)


def test_scores_move_no_rows(spark):
    raw = spark.createDataFrame([(1, 1.0)], "user_id long, risk_score_raw double")
    text = plan(risk.with_levels(raw, P))
    assert "Join" not in text and "Window" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    outer = text.split("Subquery")[0]
    assert "SinglePartition" not in outer


def test_top_k_is_a_heap(spark):
    scored = spark.createDataFrame(
        [(1, "a", 1.0, "Low")], "user_id long, role string, risk_score double, risk_level string"
    )
    assert "TakeOrderedAndProject" in plan(report.top_risky(scored))


def test_filters_reach_the_stored_table(spark, tmp_path):
    scored = pipeline.rules_only_scored(catalogue.activity(spark, SF), P)
    scored.write.parquet(str(tmp_path / "scored"))
    stored = spark.read.parquet(str(tmp_path / "scored"))
    text = plan(report.filter_scored(stored, levels=["High"], roles=["BUILDING"]).select("user_id"))
    assert "In(risk_level" in text or "EqualTo(risk_level,High)" in text
    assert "risk_score_raw" not in text.split("ReadSchema")[1]
