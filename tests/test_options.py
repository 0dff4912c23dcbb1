"""Options beside the published defaults: latest-poll snapshot, window dedupe, weather dedupe."""

import datetime as dt

from pyspark.sql import functions as F

from headway import schemas
from headway.operators import align as A
from headway.operators import weather as W
from headway.operators.extracts import filter_route
from headway.operators.windows import event_window_impact

T = dt.datetime


def test_latest_poll_snapshot(spark):
    # Two polls of the same trip: by default both polls take positions.
    rows = [("t", None, f"S{i}", 0, 1000 + 60 * i + d, None, poll, poll)
            for poll, d in (("2024-01-01T00:00:00+00:00", 0), ("2024-01-01T00:05:00+00:00", 30)) for i in range(3)]
    rt = spark.createDataFrame(rows, schemas.RT_TRIP_UPDATES)
    default = A.rt_sequence(rt)
    latest = A.rt_sequence(rt, snapshot="latest_poll")
    assert default.agg(F.max("rt_count")).collect()[0][0] == 6
    got = sorted((r.stop_id, r.rt_seq, r.poll_timestamp) for r in latest.collect())
    assert got == [(f"S{i}", i + 1, "2024-01-01T00:05:00+00:00") for i in range(3)]


def test_window_dedupe_counts_each_row_once(spark):
    r = spark.createDataFrame([("a", 1, 3, T(2024, 1, 1, 10, 15))],
                              "trip_id string, rt_seq int, delay_minutes long, actual_arrival_local_ts timestamp_ntz")
    w = spark.createDataFrame([
        ("e1", "n", "concert", "r", T(2024, 1, 1, 10), T(2024, 1, 1, 11), "s"),
        ("e2", "n", "concert", "r", T(2024, 1, 1, 10, 10), T(2024, 1, 1, 12), "s"),
    ], schemas.EVENT_WINDOWS)
    assert event_window_impact(r, w).collect()[0].stop_event_count == 2
    assert event_window_impact(r, w, dedupe=True).collect()[0].stop_event_count == 1


def test_weather_dedupe_hours(spark):
    d = spark.createDataFrame([("t", "R", T(2024, 1, 1, 10, 15), 3)],
                              "trip_id string, route_id string, actual_arrival_local_ts timestamp_ntz, delay_minutes long")
    w = spark.createDataFrame([("2024-01-01T10:00", 0.0, 1.0, 2.0, 0.0, 0.0, "x"),
                               ("2024-01-01 10:00:00", 0.0, 1.0, 2.0, 0.0, 0.0, "x")], schemas.WEATHER_HOURLY)
    assert W.enrich_weather(d, w).count() == 2
    assert W.enrich_weather(d, w, dedupe_hours=True).count() == 1


def test_route_filter(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "route_id string, v int")
    assert filter_route(df, "All").count() == 2 and filter_route(df, None).count() == 2
    assert [r.v for r in filter_route(df, "B").collect()] == [2]
