import subprocess
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from riskloom.sources import staging


def session(master, settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_configured_folder_wins():
    assert staging.shared_dir(session("yarn", {"spark.checkpoint.dir": "hdfs:/cp/"})) == "hdfs:/cp"


def test_temporary_folder_only_in_local_mode():
    local = session("local[2]", {})
    assert staging.shared_dir(local) == staging.shared_dir(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(session("yarn", {}))


def test_staged_table_keeps_rows_and_schema(spark):
    table = spark.range(10).selectExpr("id", "struct(id, 'x') AS s")
    staged = staging.stage(table, "t")
    assert staged.schema.simpleString() == table.schema.simpleString()
    assert sorted(r["id"] for r in staged.collect()) == list(range(10))


def test_staged_tables_go_with_the_session(tmp_path):
    script = f"""
import os
from pyspark.sql import SparkSession
from riskloom.sources.staging import release, stage
own = lambda: [f for f in os.listdir({str(tmp_path)!r}) if f.startswith("riskloom-")]
s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
     .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
stage(s.range(3), "a")
assert len(own()) == 1
release(s)
assert not own()
stage(s.range(3), "b")
assert len(own()) == 1
"""
    root = Path(staging.__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", script], check=True, cwd=root, capture_output=True)
    for _ in range(50):  # the JVM ends a moment after the driver
        if not list(tmp_path.glob("riskloom-*")):
            return
        time.sleep(0.2)
    raise AssertionError("staged tables were left behind")
