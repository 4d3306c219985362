import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.schemas import ACTIVITY_SCHEMA  # noqa: E402
from riskloom.sources.ship import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def activity_of(spark):
    """Build an activity log from dicts; columns left out are 0, the role "analyst"."""

    def build(rows):
        def full(row):
            day = row.get("day", 0)
            base = {f.name: 0 for f in ACTIVITY_SCHEMA}
            base.update(role="analyst", is_weekend=int(day % 7 >= 5))
            base.update(row)
            return tuple(base[f.name] for f in ACTIVITY_SCHEMA)

        return spark.createDataFrame([full(r) for r in rows], ACTIVITY_SCHEMA)

    return build


@pytest.fixture(scope="session")
def planted(spark):
    """Seeded log of 120 users and 28 days; users 0-5 behave oddly on many days."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    users, days = 120, 28
    n = users * days
    frame = pd.DataFrame({"user_id": np.repeat(np.arange(users), days), "day": np.tile(np.arange(days), users)})
    odd = (frame["user_id"] < 6) & (rng.random(n) < 0.5)
    weekend = frame["day"] % 7 >= 5
    frame["role"] = np.where(frame["user_id"] % 2 == 0, "engineer", "intern")
    frame["is_weekend"] = weekend.astype(int)
    frame["login_hour"] = np.where(odd, rng.integers(0, 5, n), np.clip(rng.normal(9, 1.2, n), 0, 23).astype(int))
    frame["files_accessed"] = np.where(odd, rng.integers(80, 300, n), rng.poisson(np.where(weekend, 3, 9)))
    frame["failed_logins"] = rng.binomial(4, 0.04, n) + np.where(odd, rng.integers(3, 8, n), 0)
    frame["sensitive_files"] = np.where(odd, rng.integers(8, 25, n), rng.binomial(3, 0.06, n))
    frame["emails_sent"] = np.where(odd, rng.integers(50, 120, n), rng.poisson(np.where(weekend, 3, 14)))
    frame["usb_usage"] = np.where(odd, 1, rng.binomial(1, 0.1, n))
    frame["after_hours"] = np.where(odd, rng.integers(3, 8, n), rng.poisson(0.3, n))
    frame["vpn_connections"] = rng.binomial(1, 0.3, n)
    frame = frame[[f.name for f in ACTIVITY_SCHEMA]]
    return spark.createDataFrame(frame, ACTIVITY_SCHEMA)
