import math

import pytest

from riskloom.operators import report, risk
from riskloom.operators.upsert import upsert
from riskloom.params import RiskParams, RiskWeights

P = RiskParams()


def scored_of(spark, scores):
    rows = [(i, s) for i, s in enumerate(scores)]
    raw = spark.createDataFrame(rows, "user_id long, risk_score_raw double")
    return risk.with_levels(raw, P)


def test_raw_risk_uses_present_columns(spark):
    df = spark.createDataFrame([(1, 0.5, 10)], "user_id long, if_score double, sensitive_total long")
    assert risk.with_raw_risk(df, P).first()["risk_score_raw"] == pytest.approx(0.15 + 2.0)
    df = spark.createDataFrame([(1, None)], "user_id long, if_score double")
    assert risk.with_raw_risk(df, P).first()["risk_score_raw"] is None


def test_level_borders(spark):
    rows = scored_of(spark, [0.0, 24.99, 25.0, 50.0, 75.0, 100.0]).orderBy("user_id").collect()
    assert [r["risk_level"] for r in rows] == ["Low", "Low", "Medium", "High", "Critical", "Critical"]
    assert [r["risk_score"] for r in rows] == [0.0, 24.99, 25.0, 50.0, 75.0, 100.0]


def test_equal_raw_risks(spark):
    rows = scored_of(spark, [3.0, 3.0]).collect()
    assert {(r["risk_score"], r["risk_level"]) for r in rows} == {(0.0, "Low")}


def test_unknown_raw_risk(spark):
    scored = scored_of(spark, [1.0, float("nan"), None, 2.0])
    rows = [(r["user_id"], r["risk_level"]) for r in risk.ranked(scored).collect()]
    assert rows == [(3, "Critical"), (0, "Low"), (1, "Low"), (2, "Low")]
    stats = report.score_stats(scored).first()
    assert (stats["max_risk_score"], stats["min_risk_score"]) == (100.0, 0.0)


def test_breakdown(spark):
    df = spark.createDataFrame(
        [(1, 50.0, 0.6, 30, 4), (2, 0.0, 0.5, 1, 0), (3, -4.0, 0.0, 0, 3)],
        "user_id long, risk_score double, if_score double, sensitive_total long, failed_total long",
    )
    got = {(r["user_id"], r["factor"]): r["contribution_pct"] for r in risk.breakdown(df, P).collect()}
    assert len(got) == 15
    assert got[1, "Sensitive Files"] == 12.0
    assert got[1, "Isolation Forest"] == 0.4
    assert got[1, "Autoencoder"] == 0.0
    assert got[2, "Sensitive Files"] == 20.0  # divisor 1 at score 0
    assert got[3, "Failed Logins"] == 7.5
    one = [r["contribution_pct"] for r in risk.breakdown_of(df, 1, P).collect()]
    assert one == sorted(one) and len(one) == 5
    bare = risk.breakdown(df.drop("risk_score"), P).where("user_id = 1").collect()
    assert {r["factor"]: r["contribution_pct"] for r in bare}["Sensitive Files"] == 600.0


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (1, "admin", 100.0, "Critical", 0.61251),
        (2, "intern", 62.25, "High", 0.5),
        (3, "intern", 30.35, "Medium", 0.4),
        (4, None, 0.0, "Low", 0.3),
    ]
    return spark.createDataFrame(
        rows, "user_id long, role string, risk_score double, risk_level string, if_score double"
    )


def test_filters(scored):
    ids = lambda df: sorted(r["user_id"] for r in df.collect())
    assert ids(report.filter_scored(scored)) == [1, 2, 3, 4]
    assert ids(report.filter_scored(scored, levels=["High", "Medium"], roles=["intern"])) == [2, 3]
    assert ids(report.filter_scored(scored, low=30.35, high=62.25)) == [2, 3]
    assert ids(report.filter_scored(scored.drop("role"), roles=["x"])) == [1, 2, 3, 4]


def test_reports(scored):
    assert [r["user_id"] for r in report.top_risky(scored, 2).collect()] == [1, 2]
    assert {r["risk_level"]: r["pct"] for r in report.level_shares(scored).collect()}["Low"] == 25.0
    assert report.critical_alarm(scored).first()[0] == 1
    assert report.critical_alarm(scored.where("user_id > 1")).count() == 0
    cross = {r["role"]: tuple(r)[1:] for r in report.role_level_crosstab(scored).collect()}
    assert cross == {"admin": (1, 0, 0, 0), "intern": (0, 1, 1, 0)}
    bins = {r["risk_level"]: r["bin"] for r in report.score_histogram(scored).collect()}
    assert bins == {"Critical": 30, "High": 19, "Medium": 10, "Low": 1}
    table = {r["user_id"]: r for r in report.alert_table(scored).collect()}
    assert (table[2]["risk_score"], table[1]["if_score"]) == (62.2, 0.613)
    card = report.user_cards(report.lookup_user(scored, 1)).first()
    assert (card["role"], card["risk_score"]) == ("Admin", 100.0)
    assert report.behaviour_profile(scored.withColumn("usb_total", scored["risk_score"])).count() == 4
    assert report.behaviour_profile(scored) is None and report.model_pair_view(scored) is None
    full = report.full_report(scored, levels=["High"])
    assert full["kpi"].first()["total_users"] == 4 and full["view"].count() == 1
    assert [r[0] for r in full["alerts_export"].select("user_id").orderBy("user_id").collect()] == [1, 2]


def test_no_rows_no_stats(scored):
    assert report.score_stats(scored.limit(0)).count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "user_id long, risk_score_raw double")
    new = spark.createDataFrame([(2, 9.0, "x"), (3, 3.0, "y")], "user_id long, risk_score_raw double, role string")
    got = sorted(tuple(r) for r in upsert(old, new).select("user_id", "risk_score_raw").collect())
    assert got == [(1, 1.0), (2, 9.0), (3, 3.0)]


def test_parameters_from_settings():
    p = RiskParams.from_env(
        {"SEED": "7", "IF_N_ESTIMATORS": "ten", "SVM_GAMMA": "0.5", "WEIGHT_AE_SCORE": "0.2"}
    )
    assert (p.seed, p.forest.trees, p.svm.gamma, p.weights.ae_score) == (7, 200, 0.5, 0.2)
    assert RiskParams.from_env({}) == RiskParams()
    assert math.isclose(sum(w for _, w in RiskWeights().items()), 1.0)


def test_unknown_scores_rank_last_in_the_top_list(spark):
    rows = [(1, "a", float("nan"), "Low"), (2, "a", 90.0, "Critical"), (3, "a", 10.0, "Low"), (4, "a", None, "Low")]
    scored = spark.createDataFrame(rows, "user_id long, role string, risk_score double, risk_level string")
    top = {r["rank"]: r["user_id"] for r in report.top_risky(scored).collect()}
    assert top == {1: 2, 2: 3, 3: 1, 4: 4}
