from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

PING_SCHEMA = ("event_id long, mmsi long, ts timestamp_ntz, date date, latitude float, longitude float, "
               "sog float, nav_status string, ship_type string, mobile_type string, name string")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from quayside.session import configure_session
    s = (SparkSession.builder.master("local[4]").appName("quayside-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure_session(s)
    yield s


def ping(event_id=1, mmsi=1, ts="2026-02-01 08:00:00", lat=56.15, lon=10.2, sog=5.0,
         nav="Under way using engine", ship_type="Cargo", mobile="Class A", name="SHIP"):
    t = dt.datetime.fromisoformat(ts) if ts is not None else None
    return (event_id, mmsi, t, t.date() if t else None, lat, lon, sog, nav, ship_type, mobile, name)


@pytest.fixture()
def make_pings(spark):
    def _make(rows):
        return spark.createDataFrame(rows, PING_SCHEMA)
    return _make
