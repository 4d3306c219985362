import math

import pandas as pd
import pytest

from riskloom.operators import features, scaling
from riskloom.schemas import FEATURE_COLS


def by_user(df):
    return {r["user_id"]: r.asDict() for r in df.collect()}


def test_edge_users(activity_of):
    log = activity_of(
        [
            {"user_id": 1, "day": 0, "login_hour": 9, "files_accessed": 4, "sensitive_files": 3},
            {"user_id": 2, "day": 0, "files_accessed": 3, "role": None},
            {"user_id": 2, "day": 1, "files_accessed": 5, "role": "late"},
            {"user_id": 3, "day": 5, "files_accessed": 6, "role": None},
            {"user_id": None, "day": 9, "files_accessed": 99},
        ]
    )
    got = by_user(features.user_features(log))
    assert set(got) == {1, 2, 3}
    assert got[1]["login_std"] == got[1]["files_std"] == 0.0
    assert got[1]["weekend_activity_ratio"] == 0.0
    assert got[3]["weekend_activity_ratio"] == 3.0
    assert (got[1]["role"], got[2]["role"], got[3]["role"]) == ("analyst", "late", "unknown")
    assert got[2]["files_std"] == pytest.approx(math.sqrt(2))
    # Four distinct days in the whole log, the one without a user included.
    assert got[1]["sensitive_ratio"] == pytest.approx(3 / (4 * 4 + 1))


def test_missing_values_are_skipped(activity_of):
    log = activity_of(
        [
            {"user_id": 1, "day": 0, "login_hour": None, "files_accessed": 2},
            {"user_id": 1, "day": 1, "login_hour": 8, "files_accessed": None},
            {"user_id": 2, "day": 1, "login_hour": None, "files_accessed": None},
        ]
    )
    got = by_user(features.user_features(log))
    assert got[1]["login_mean"] == 8.0 and got[1]["files_mean"] == 2.0
    assert got[2]["login_mean"] == got[2]["files_max"] == 0.0


def test_against_pandas(planted):
    log = planted.toPandas()
    got = features.user_features(planted).toPandas().set_index("user_id").sort_index()
    per_user = log.groupby("user_id")
    days = log["day"].nunique()
    want = pd.DataFrame(
        {
            "login_mean": per_user["login_hour"].mean(),
            "login_std": per_user["login_hour"].std(),
            "files_max": per_user["files_accessed"].max(),
            "files_std": per_user["files_accessed"].std(),
            "after_hours_mean": per_user["after_hours"].mean(),
            "usb_rate": per_user["usb_usage"].sum() / days,
            "sensitive_ratio": per_user["sensitive_files"].sum()
            / (per_user["files_accessed"].mean() * days + 1),
        }
    )
    for column in want:
        assert (got[column] - want[column]).abs().max() < 1e-9, column


def test_merged_statistics_equal_one_pass(spark, planted):
    first, second = planted.where("day < 9"), planted.where("day >= 9 or user_id = 3")
    merged = features.merge_stats(features.user_stats(first), features.user_stats(second))
    whole = features.user_stats(first.unionByName(second))
    key = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    assert key(merged) == key(whole)


def test_subset_counts_its_own_days(spark, activity_of):
    log = activity_of(
        [{"user_id": 1, "day": 0, "usb_usage": 1}] + [{"user_id": 2, "day": d} for d in range(4)]
    )
    assert by_user(features.user_features(log.where("user_id = 1")))[1]["usb_rate"] == 1.0
    assert by_user(features.user_features(log))[1]["usb_rate"] == 0.25


def test_scaler(spark):
    wide = spark.createDataFrame(
        [(i, *([float(v)] * 17), 5.0) for i, v in enumerate((1, 2, 4))],
        "user_id long, " + ", ".join(f"{c} double" for c in FEATURE_COLS),
    )
    stats = {r["feature"]: (r["mean"], r["std"]) for r in scaling.fit_scaler(wide).collect()}
    assert stats["login_mean"][0] == pytest.approx(7 / 3)
    assert stats["login_mean"][1] == pytest.approx(math.sqrt(14 / 9))
    last = FEATURE_COLS[-1]
    for scaled in (scaling.scale(wide), scaling.apply_scaler(wide, stats)):
        rows = by_user(scaled)
        assert all(r[last] == 0.0 for r in rows.values())
        assert rows[2]["files_max"] == pytest.approx((4 - 7 / 3) / math.sqrt(14 / 9))


def test_missing_feature_is_named(spark):
    with pytest.raises(ValueError, match="login_std"):
        scaling.fit_scaler(spark.createDataFrame([(1.0,)], "login_mean double"))


@pytest.mark.parametrize("days", [[0, 1, 7], [-3, 0, 1, 1], [0, 32_766, 32_767, 70_000], [5]])
def test_day_count(activity_of, days):
    log = activity_of([{"user_id": u, "day": d} for u in (1, 2) for d in days])
    _, count = features.stored_stats(log.repartition(3))
    assert count == len(set(days)) == features.distinct_days(log).first()[0]


def test_empty_log(activity_of):
    log = activity_of([{"user_id": 1}]).where("day > 5")
    assert features.user_features(log).count() == 0


def test_std_of_large_counts(activity_of):
    rows = [{"user_id": 1, "day": d, "files_accessed": 10**9 + d % 2} for d in range(4)]
    row = features.user_features(activity_of(rows)).first()
    assert row["files_std"] == pytest.approx(0.5773502691896258)


def test_days_of_any_number_are_counted(activity_of):
    rows = [{"user_id": 1, "day": d} for d in (-3, 0, 40_000, 40_000)]
    assert features.stored_stats(activity_of(rows))[1] == 3
