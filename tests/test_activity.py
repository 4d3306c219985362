from datetime import datetime

import pytest

from riskloom.operators.activity import daily_activity, for_users
from riskloom.schemas import ACTIVITY_SCHEMA
from riskloom.sources.tables import (
    load_or_compute,
    read_activity,
    rejected_activity,
    stored_table,
    write_alerts_csv,
    write_table,
)


def test_events_roll_up_to_user_days(spark):
    rows = [
        (1, datetime(2024, 1, 1, 9), "view", 1.0),
        (1, datetime(2024, 1, 1, 21), "view", 200.0),
        (1, datetime(2024, 1, 1, 5), "error", 1.0),
        (2, datetime(2024, 1, 2, 13), "view", float("nan")),  # missing, not large
        (1, datetime(2024, 1, 6, 12), "signup", 1.0),
        (2, datetime(2024, 1, 2, 12), "purchase", 1.0),
        (3, datetime(2024, 1, 2, 12), "click", 1.0),  # no role
        (None, datetime(2024, 1, 2, 12), "click", 1.0),
        (1, None, "click", 1.0),
    ]
    events = spark.createDataFrame(
        rows, "user_id long, ts timestamp_ntz, event_type string, value double"
    )
    roles = spark.createDataFrame([(1, "A"), (2, "B")], "user_id long, role string")
    got = daily_activity(events, roles)
    assert [f.name for f in got.schema] == [f.name for f in ACTIVITY_SCHEMA]
    assert [f.dataType for f in got.schema] == [f.dataType for f in ACTIVITY_SCHEMA]
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "A", 0, 0, 5, 2, 1, 0, 0, 1, 2, 0),
        (1, "A", 5, 1, 12, 0, 0, 0, 0, 0, 0, 1),
        (2, "B", 1, 0, 12, 1, 0, 1, 0, 0, 0, 0),
        (3, None, 1, 0, 12, 0, 0, 0, 1, 0, 0, 0),
    ]


def test_restrict_to_user_set(spark, activity_of):
    log = activity_of([{"user_id": u, "day": d} for u in (1, 2, 3) for d in (0, 1)])
    users = spark.createDataFrame([(1,), (3,), (3,), (9,)], "user_id long")
    assert sorted(r["user_id"] for r in for_users(log, users).collect()) == [1, 1, 3, 3]


NAMES = [f.name for f in ACTIVITY_SCHEMA]


def csv_of(path, lines, names=NAMES):
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    return str(path)


def test_csv_with_gaps(spark, tmp_path):
    path = csv_of(
        tmp_path / "log.csv", ["1,admin,0,0,9.0,NaN,1,2,,0,1,1", "2,,1,0, 8 ,3.0,0,0,null,0,0,0"]
    )
    got = sorted(tuple(r) for r in read_activity(spark, path, "csv").collect())
    assert got == [
        (1, "admin", 0, 0, 9, None, 1, 2, None, 0, 1, 1),
        (2, None, 1, 0, 8, 3, 0, 0, None, 0, 0, 0),
    ]
    assert rejected_activity(spark, path).count() == 0
    with pytest.raises(ValueError):
        read_activity(spark, path, "xml")


def test_csv_ids_beyond_doubles(spark, tmp_path):
    ids = [2**53, 2**53 + 1, 2**63 - 1, -(2**63)]
    path = csv_of(tmp_path / "log.csv", [f"{i},a,0,0,9,1,1,2,0,0,1,1" for i in ids])
    got = read_activity(spark, path, "csv")
    assert sorted(r["user_id"] for r in got.collect()) == sorted(ids)
    assert [f.dataType for f in got.schema] == [f.dataType for f in ACTIVITY_SCHEMA]


def test_csv_columns_go_by_name(spark, tmp_path):
    names = ["note", *NAMES[::-1]]
    row = dict(zip(NAMES, [7, "admin", 3, 1, 9, 4, 5, 6, 8, 0, 2, 1])) | {"note": "x"}
    path = csv_of(tmp_path / "log.csv", [",".join(str(row[c]) for c in names)], names)
    got = read_activity(spark, path, "csv")
    assert got.columns == NAMES and got.first().asDict() == {c: row[c] for c in NAMES}
    short = csv_of(tmp_path / "short.csv", ["1"], ["user_id"])
    with pytest.raises(ValueError, match="role, day"):
        read_activity(spark, short, "csv")


def test_csv_files_of_other_column_orders_are_not_mixed(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    csv_of(folder / "a.csv", ["1,a,0,0,9,1,1,2,0,0,1,1"])
    csv_of(folder / "b.csv", ["0,a,1,0,9,1,1,2,0,0,1,1"], ["day", "role", "user_id", *NAMES[3:]])
    with pytest.raises(Exception, match="(?i)header"):
        read_activity(spark, str(folder), "csv").collect()


def test_csv_lines_that_are_no_rows(spark, tmp_path):
    lines = {
        "1,a,0,0,9,1,1,2,0,0,1,1": None,
        "2,a,0,0,9,1.5,1,2,0,0,1,1": ["files_accessed"],
        "9223372036854775808,a,0,0,9,1,1,2,0,0,1,1": ["user_id"],
        "3,a,2147483648,0,nine,1,1,2,0,0,1,1": ["day", "login_hour"],
        "4,a,0": ["line"],
        "5,a,0,0,9,1,1,2,0,0,1,1,7": ["line"],
    }
    path = csv_of(tmp_path / "log.csv", list(lines))
    assert [r["user_id"] for r in read_activity(spark, path, "csv").collect()] == [1]
    got = {r["record"]: r["reasons"] for r in rejected_activity(spark, path).collect()}
    assert got == {line: reasons for line, reasons in lines.items() if reasons}


def test_load_or_compute(spark, tmp_path):
    path, source = str(tmp_path / "t"), tmp_path / "in"
    source.mkdir()
    (source / "a").write_text("1")
    calls = []

    def compute():
        calls.append(1)
        return spark.range(100).repartition(4)

    def ask():
        return load_or_compute(spark, path, compute, str(source)).count(), len(calls)

    assert ask() == ask() == (100, 1)
    (source / "b").write_text("2")  # the inputs have changed
    assert ask() == ask() == (100, 2)
    part = next(p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-"))
    part.unlink()  # a file got lost, the marker is there
    assert ask() == ask() == (100, 3)
    (tmp_path / "t" / "_stored.json").unlink()  # half a table without a note
    assert ask() == (100, 4)
    (tmp_path / "t" / "_stored.json").write_text("{")  # against its checksum
    assert ask() == (100, 5)
    (tmp_path / "t" / "_stored.json").write_text("{")
    (tmp_path / "t" / "._stored.json.crc").unlink()
    assert ask() == (100, 6)
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("t.")] == []


def test_a_table_may_replace_itself(spark, tmp_path):
    path = str(tmp_path / "deep" / "t")
    write_table(spark.range(3), path)
    write_table(spark.read.parquet(path).where("id > 0"), path)
    assert stored_table(spark, path).count() == 2
    with pytest.raises(Exception):
        write_table(spark.range(3).selectExpr("assert_true(id < 2) AS x"), path)
    assert stored_table(spark, path).count() == 2  # a failed write leaves the old one


def test_alert_export(spark, tmp_path):
    path = str(tmp_path / "alerts")
    write_alerts_csv(spark.createDataFrame([(1, "High")], "user_id long, risk_level string"), path)
    assert spark.read.csv(path, header=True).collect()[0].asDict() == {
        "user_id": "1",
        "risk_level": "High",
    }
