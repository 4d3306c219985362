import dataclasses
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.models.ensemble import fit_models
from riskloom.operators.activity import daily_activity
from riskloom.operators.features import user_features
from riskloom.params import AutoencoderParams, ForestParams, RiskParams
from riskloom.plans.pipeline import rules_only_scored, score_requests
from riskloom.streaming.batch_log import BatchLog
from riskloom.streaming.daily import daily_activity_stream, rolled_up, start_roll_up
from riskloom.streaming.job import METADATA_COLS, RiskStream, replay_source
from riskloom.streaming.levels import counted, level_counts, multiset
from riskloom.streaming.status import LiveStatus

P = RiskParams()


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def close(a, b, columns):
    a, b = (x.select("user_id", *columns).toPandas().sort_values("user_id") for x in (a, b))
    return len(a) == len(b) and np.allclose(a.to_numpy(float), b.to_numpy(float), atol=1e-9)


def feed(spark, part, folder, job=None, models=None, params=P):
    """One more file for a real stream, which goes on from where it stopped."""
    job = job or RiskStream(spark, folder, params, models, total_batches=3)
    part.coalesce(1).write.mode("append").parquet(f"{folder}-in")
    query = job.start(replay_source(spark, f"{folder}-in", 1), available_now=True)
    query.awaitTermination()
    return job, query


def run(spark, parts, folder, **kinds):
    for part in parts:
        job, _ = feed(spark, part, folder, **kinds)  # each time a new job over the same folder
    return job


@pytest.fixture(scope="module")
def parts(planted):
    """Users arrive in groups; some come again later with more days."""
    first = planted.where("user_id < 60 and day < 20")
    second = planted.where("user_id >= 60")
    third = planted.where("user_id < 60 and day >= 20")
    return [first, second, third]


def test_stream_equals_batch(spark, planted, parts, tmp_path):
    job = run(spark, parts, str(tmp_path / "out"))
    assert rows(job.current_scores()) == rows(rules_only_scored(planted, P))
    assert close(job.current_features(), user_features(planted), user_features(planted).columns[2:])
    scores = [r["risk_score"] for r in job.current_scores().collect()]
    assert scores == sorted(scores, reverse=True)
    meta = job.metadata().orderBy("batch_num").collect()
    assert job.metadata().columns == METADATA_COLS
    assert [(r["batch_num"], r["users_in_batch"], r["total_users_processed"]) for r in meta] == [
        (1, 60, 60),
        (2, 60, 120),
        (3, 60, 120),
    ]
    levels = rules_only_scored(planted, P).groupBy("risk_level").count().collect()
    levels = {r["risk_level"]: r["count"] for r in levels}
    assert meta[-1]["critical_risk_count"] == levels.get("Critical", 0)
    assert job.current_stats().first()["total_users"] == 120


def forget(folder, *kinds):
    """Take back the newest commit of the query, and of the job's own tables, as a crash would."""
    for kind in kinds:
        found = [p for p in (folder / kind).iterdir() if not p.name.startswith(".")]
        newest = max(found, key=lambda p: int(p.name.removeprefix("batch=")))
        if newest.is_dir():
            shutil.rmtree(newest)
        else:
            newest.unlink()
            (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("lost", [["checkpoint/commits"], ["checkpoint/commits", "commits"]])
def test_order_and_replay_do_not_matter(spark, planted, parts, tmp_path, lost):
    folder = tmp_path / "out"
    job = run(spark, parts[::-1], str(folder))
    before = rows(job.current_scores())
    assert before == rows(rules_only_scored(planted, P))
    forget(folder, *lost)
    job, query = feed(spark, parts[0].limit(0), str(folder))
    assert query.recentProgress[0]["batchId"] == 2  # the last batch again
    assert rows(job.current_scores()) == before
    meta = job.metadata().orderBy("batch_num").collect()
    assert [(r["batch_num"], r["total_users_processed"]) for r in meta] == [(1, 60), (2, 120), (3, 120)]
    times = [r["timestamp"] for r in meta]
    assert times == sorted(times)


def watched(spark, part, folder, keep=1000):
    job = RiskStream(spark, folder, P, total_batches=3)
    status = LiveStatus(job, keep)
    spark.streams.addListener(status)
    try:
        feed(spark, part, folder, job=job)
        assert status.wait(60)
    finally:
        spark.streams.removeListener(status)
    return status.table().collect()


def test_live_status_goes_on_after_a_restart_and_a_replay(spark, planted, parts, tmp_path):
    folder = tmp_path / "out"
    sizes = [p.count() for p in parts]
    seen = [r for p in parts[:2] for r in watched(spark, p, str(folder))]
    forget(folder, "checkpoint/commits")  # batch 1 is committed by the job, not by Spark
    seen += watched(spark, parts[2], str(folder))
    assert [(r["batch_num"], r["rows_in_batch"], r["users_in_batch"], r["users_so_far"]) for r in seen] == [
        (1, sizes[0], 60, 60),
        (2, sizes[1], 60, 120),
        (2, sizes[1], 60, 120),
        (3, sizes[2], 60, 120),
    ]
    assert [round(r["progress"], 3) for r in seen] == [0.333, 0.667, 0.667, 1.0]
    times = [r["updated"] for r in seen]
    assert times == sorted(times)
    meta = RiskStream(spark, str(folder), P).metadata().orderBy("batch_num").collect()
    assert [r["total_users_processed"] for r in meta] == [60, 120, 120]


def test_live_status_keeps_the_newest_batches(spark, parts, tmp_path):
    folder = str(tmp_path / "out")
    for part in parts[:2]:
        part.coalesce(1).write.mode("append").parquet(f"{folder}-in")
    (row,) = watched(spark, parts[2], folder, keep=1)
    assert (row["batch_num"], row["users_so_far"]) == (3, 120)


def test_live_status_without_batches(spark, parts, tmp_path):
    status = LiveStatus(RiskStream(spark, str(tmp_path / "none"), P))
    assert status.table().count() == 0 and not status.wait(0)


def test_nothing_scored_yet(spark, tmp_path):
    job = RiskStream(spark, str(tmp_path / "none"), P)
    assert job.current_scores() is None and job.metadata() is None and job.current_stats() is None


def test_a_batch_of_one_user_touches_one_key(spark, planted, tmp_path):
    folder = str(tmp_path / "out")
    feed(spark, planted, folder)
    more = planted.where("user_id = 7 and day = 3").withColumn("failed_logins", F.lit(5).cast("long"))
    job, query = feed(spark, more, folder)
    state = query.lastProgress["stateOperators"][0]
    assert (state["numRowsUpdated"], state["numRowsTotal"]) == (1, 120)
    assert job.users.batch(1).count() == 1
    assert job.raws.batch(1).agg(F.sum("n"), F.count("n")).first() == (0, 2)  # one out, one in
    assert job.last_commit()["raws_read"] <= 30
    again = planted.unionByName(more)
    assert rows(job.current_scores()) == rows(rules_only_scored(again, P))


def test_the_session_keeps_its_state_store(spark, planted, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    feed(spark, planted.limit(1), str(tmp_path / "out"))
    assert spark.conf.get(name) == before


def test_missing_values_days_and_roles(spark, activity_of, tmp_path):
    first = activity_of(
        [
            {"user_id": 1, "day": 5, "role": "late", "files_accessed": 2**53 + 1, "login_hour": None},
            {"user_id": 1, "day": 2, "role": None, "sensitive_files": None},
            {"user_id": 2, "day": 999, "role": "z", "failed_logins": 3},
            {"user_id": None, "day": 3},
        ]
    ).withColumn("day", F.expr("nullif(day, 999)"))
    second = activity_of(
        [
            {"user_id": 1, "day": 3, "role": "early", "files_accessed": 1},
            {"user_id": 2, "day": 3, "role": "b"},
            {"user_id": 2, "day": 3, "role": "a", "emails_sent": 4},
        ]
    )
    job = run(spark, [first, second], str(tmp_path / "out"))
    whole = first.unionByName(second)
    want = user_features(whole)
    assert rows(job.current_features()) == rows(want)
    assert rows(job.current_scores()) == rows(rules_only_scored(whole, P))
    assert job.current_features().where("user_id = 1").first()["role"] == "early"


def test_small_folders_are_merged(spark, planted, tmp_path):
    folder = tmp_path / "out"
    for i in range(7):
        job = RiskStream(spark, str(folder), P, keep=2)
        feed(spark, planted.where(f"user_id % 7 = {i} or user_id = 1"), str(folder), job)
    for table in ("users", "raws", "commits"):
        names = [p.name for p in (folder / table).iterdir()]
        assert len([n for n in names if n.startswith("upto=")]) <= 2
        assert len([n for n in names if n.startswith("batch=")]) <= 4
    assert sorted(r["batch_num"] for r in job.metadata().collect()) == list(range(1, 8))
    whole = planted
    for i in range(7):
        if i != 1:
            whole = whole.unionByName(planted.where("user_id = 1"))
    assert rows(job.current_scores()) == rows(rules_only_scored(whole, P))


def log_of(spark, folder, keep=2):
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    return BatchLog(spark, str(folder), "k int, n long", merge, keep)


def test_batch_log(spark, tmp_path):
    log = log_of(spark, tmp_path / "log")
    one = spark.sql("SELECT 1 AS k, 1L AS n")
    assert log.last() is None and log.table(5).count() == 0
    for i in range(6):
        log.write(one, i)
        log.write(one, i)  # a replay overwrites
        log.compact(i)
        assert log.table(i).collect() == [(1, i + 1)]
        assert log.table(i - 1).agg(F.sum("n")).first()[0] in (i or None, None)
    (tmp_path / "log" / "upto=9").mkdir()  # a merge that broke off
    (tmp_path / "log" / "batch=9").mkdir()
    assert log.last() == 5 and log.last(before=5) == 4
    assert log.table(9).collect() == [(1, 6)]


def naive_levels(values, params=P):
    known = [v for v in values if v == v]
    low, high = min(known), max(known)
    out = {"Critical": 0, "High": 0, "Medium": 0, "Low": 0}
    for v in known:
        score = v * 0.0 if low == high else (v - low) / (high - low) * 100
        at = [("Critical", params.critical), ("High", params.high), ("Medium", params.medium)]
        out[next((lv for lv, t in at if score >= t), "Low")] += 1
    return low, high, out


def levels_of(spark, values):
    raws = multiset(counted(spark.createDataFrame([(v,) for v in values], "risk_score_raw double"), 1))
    raws = spark.createDataFrame(raws.collect(), raws.schema)
    cells = {r["cell"]: r["n"] for r in raws.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    return level_counts(raws, cells, P), raws.count()


@pytest.mark.parametrize("spread", ["wide", "ties", "signs", "one value", "tiny range"])
def test_levels_equal_a_full_count(spark, spread):
    rng = np.random.default_rng(11)
    values = {
        "wide": rng.lognormal(3, 2, 4000),
        "ties": rng.integers(0, 9, 500).astype(float),
        "signs": rng.normal(0, 5, 3000),
        "one value": np.full(20, 4.5),
        "tiny range": 1e6 + rng.random(400) * 1e-6,
    }[spread].tolist() + [0.0, -0.0] * (spread == "signs")
    found, _ = levels_of(spark, values)
    assert (found.low, found.high, found.users) == naive_levels(values)


def test_levels_at_exact_borders_and_without_numbers(spark):
    values = [-1.0, 0.0, 1.0, 2.0, 3.0, float("nan"), 0.0]  # borders at 0, 1 and 2
    found, _ = levels_of(spark, values)
    assert (found.low, found.high, found.users) == naive_levels(values)
    assert levels_of(spark, [float("nan"), None])[0].low is None
    found, _ = levels_of(spark, [1.0, float("inf"), 5.0])
    assert found.high == float("inf") and found.users["Low"] == 3


def test_a_batch_reads_few_raw_risks(spark):
    values = np.random.default_rng(12).gamma(2.0, 20.0, 20_000).tolist()
    found, distinct = levels_of(spark, values)
    assert (found.low, found.high, found.users) == naive_levels(values)
    assert found.rows_read <= 0.1 * distinct


def test_stream_with_models_equals_scoring_everyone(spark, planted, parts, tmp_path):
    small = dataclasses.replace(
        P, forest=ForestParams(trees=30), autoencoder=AutoencoderParams(max_epochs=40)
    )
    models, _ = fit_models(user_features(planted), small, ("forest", "autoencoder"))
    folder = str(tmp_path / "m")
    job = run(spark, parts, folder, models=models, params=small)
    want = score_requests(user_features(planted), models, small)
    assert close(job.current_scores(), want, ["if_score", "svm_score", "ae_score", "risk_score_raw"])
    # Without new days only the users of the batch are scored again.
    feed(spark, planted.where("user_id = 7 and day = 3"), folder, job)
    assert job.raws.batch(3).count() <= 2
    again = planted.unionByName(planted.where("user_id = 7 and day = 3"))
    want = score_requests(user_features(again), models, small)
    assert close(job.current_scores(), want, ["if_score", "svm_score", "ae_score", "risk_score_raw"])


def test_daily_roll_up_of_a_stream(spark, tmp_path):
    events = spark.sql(
        """SELECT id % 3 AS user_id, timestampadd(HOUR, CAST(id * 5 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts,
                  'view' AS event_type, 1.0D AS value FROM range(60)"""
    )
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    roles = spark.createDataFrame([(0, "A"), (1, "B")], "user_id long, role string")
    source = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    days = daily_activity_stream(source, roles)
    query = (
        days.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.schema(days.schema).parquet(str(tmp_path / "out")).collect()
    # 295 hours of events; days that ended before the watermark (one day back) are out.
    assert {r["day"] for r in got} == set(range(11))
    assert {r["role"] for r in got} == {"A", "B", None}

    start_roll_up(source, roles, str(tmp_path / "all")).awaitTermination()
    events.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # some days grow
    start_roll_up(source, roles, str(tmp_path / "all")).awaitTermination()
    whole = daily_activity(events.withColumn("ts", F.col("ts").cast("timestamp")), roles)
    rolled = {(r["user_id"], r["day"]): r for r in rolled_up(spark, str(tmp_path / "all")).collect()}
    assert rolled.keys() == {(r["user_id"], r["day"]) for r in whole.collect()}
    assert rolled[1, 12]["files_accessed"] > whole.where("user_id = 1 and day = 12").first()["files_accessed"]
