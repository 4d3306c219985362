import numpy as np
import pytest

from riskloom.operators import batches
from riskloom.params import RiskParams

P = RiskParams()


def brute_force(raw, size):
    out = []
    for number, start in enumerate(range(0, len(raw), size), 1):
        seen = np.array(raw[: start + size], dtype=float)
        low, high = np.nanmin(seen), np.nanmax(seen)
        score = seen * 0 if low == high else (seen - low) / (high - low) * 100
        critical = int((score >= 75).sum())
        total = -(-len(raw) // size)
        done = min(start + size, len(raw))
        out.append((number, total, done - start, done, int((score >= 50).sum()) - critical, critical))
    return out


@pytest.mark.parametrize("chunk", [3, 10_000])
@pytest.mark.parametrize(
    "raw",
    [
        np.random.default_rng(0).normal(size=43).tolist(),
        [float(i) for i in range(40)],  # every batch brings a new extreme
        [5.0] * 12 + [1.0, 9.0, 7.0],
        [2.0, float("nan"), 3.0, 8.0, None, 1.0],
    ],
)
def test_metadata_equals_replaying_every_batch(spark, raw, chunk):
    table = spark.createDataFrame(
        [(100 + 3 * i, r) for i, r in enumerate(raw)], "user_id long, risk_score_raw double"
    )
    got = batches.batch_metadata(table.repartition(5), 4, P, chunk).orderBy("batch_num").collect()
    want = brute_force([np.nan if r is None else r for r in raw], 4)
    assert [tuple(r) for r in got] == want


def test_latest_and_progress(spark):
    meta = spark.createDataFrame(
        [(1, 3, 10, 10, 2, 1), (3, 3, 5, 25, 4, 2)],
        "batch_num int, total_batches int, users_in_batch int, total_users_processed int, "
        "high_risk_count long, critical_risk_count long",
    )
    assert batches.latest_metadata(meta).first()["batch_num"] == 3
    rows = batches.batch_progress(meta, 10).orderBy("batch_num").collect()
    assert rows[0]["progress"] == pytest.approx(1 / 3)
    assert rows[1]["alert_text"] == "2 Critical + 4 High risk users detected"
    small = batches.batch_progress(meta, 5).orderBy("batch_num").collect()
    assert small[1]["progress"] == 1.0
    stamped = meta.selectExpr("*", "TIMESTAMP'2024-05-01 11:04:33' AS timestamp")
    assert batches.batch_progress(stamped, 10).first()["updated_at"] == "11:04:33"


def test_one_plan_for_any_number_of_range_changes(spark):
    def scans(raw):
        table = spark.createDataFrame(list(enumerate(raw)), "user_id long, risk_score_raw double")
        plan = batches.batch_metadata(table, 2, P)._jdf.queryExecution().executedPlan().toString()
        return plan.count("FileScan")

    assert scans([float(i) for i in range(60)]) == scans([1.0] * 60)
