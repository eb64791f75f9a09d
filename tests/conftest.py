from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import SparkSession

from tripweave.schemas import PING

DAY = dt.date(2024, 1, 1)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def pings_of(spark):
    """Rows (vehicle, second, status[, lng, lat, speed]) in source order to pings."""

    def build(rows):
        full = []
        for i, (vehicle, sec, status, *rest) in enumerate(rows):
            lng, lat, speed = (*rest, *(114.0, 22.6, 30.0)[len(rest):])
            full.append((i, vehicle, DAY, sec, lng, lat, status, speed))
        return spark.createDataFrame(full, PING)

    return build


@pytest.fixture(scope="session")
def trips_of(spark):
    """Rows (vehicle, s_sec, e_sec, duration_min, distance_km, avg_speed) to trips."""

    def build(rows):
        full = [
            (i, v, DAY, s, 114.0, 22.6, e, 114.1, 22.7, int(round(d * 60)), d, km, kmh, s // 3600)
            for i, (v, s, e, d, km, kmh) in enumerate(rows)
        ]
        from tripweave.schemas import TRIP

        return spark.createDataFrame(full, TRIP)

    return build
