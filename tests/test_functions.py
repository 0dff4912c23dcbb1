"""Column helpers: the semantic hazards H1-H5, H9, H19-H21 of SURVEY §7.1."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.functions import (
    circular_seconds_distance,
    delay_category,
    hms_seconds,
    local_epoch_seconds,
    local_wall_clock,
    minute_diff,
    offset_bucket,
    parse_local_hour,
    parse_local_time,
    pct,
    pct_or_zero,
    precipitation_bucket,
    rain_step,
    risk_level,
    round_half,
    scheduled_wall_clock,
    wind_step,
)


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_minute_diff_counts_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0)),
            (dt.datetime(2024, 1, 1, 10, 1, 0), dt.datetime(2024, 1, 1, 10, 0, 59)),
            (dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 10, 0, 59)),
            (dt.datetime(2024, 1, 1, 23, 59, 30), dt.datetime(2024, 1, 2, 0, 1, 0))]
    got = one(spark, minute_diff(F.col("a"), F.col("b")), "a timestamp_ntz, b timestamp_ntz", rows)
    assert got == [1, -1, 0, 2]


def test_round_half_and_pct(spark):
    import random

    import duckdb

    vals = [2.675, 1.005, -1.125, 0.125, 0.285] + [round(random.Random(i).uniform(-50, 50), 3) for i in range(2000)]
    got = one(spark, round_half(F.col("x"), 2), "x double", [(v,) for v in vals])
    con = duckdb.connect()
    want = [con.execute("SELECT ROUND(CAST(? AS DOUBLE) * 100.0) / 100.0", [v]).fetchone()[0] for v in vals]
    assert got == want
    assert got[:5] == [2.68, 1.0, -1.13, 0.13, 0.28]  # 2.675 * 100 is exactly 267.5 as a double
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 0)], "a long, b long")
    p = [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()]
    z = [r[0] for r in df.select(pct_or_zero(F.col("a"), F.col("b"))).collect()]
    assert p == [33.3, None, None] and z == [33.3, 0.0, 0.0]


def test_sequence_guard_for_negative_span(spark):
    from headway.operators.align import candidate_offsets

    df = spark.createDataFrame([("t1", 2, 5), ("t2", 3, 3)], "trip_id string, rt_count long, static_count long")
    got = sorted((r.trip_id, r.seq_offset) for r in candidate_offsets(df).collect())
    assert got == [("t1", 0), ("t1", 1), ("t1", 2), ("t1", 3), ("t2", 0)]


def test_hms_rolls_past_midnight(spark):
    rows = [(dt.date(2024, 1, 1), "25:10:05"), (dt.date(2024, 1, 1), "24:30:00"), (dt.date(2024, 1, 1), "9:59:00")]
    got = one(spark, scheduled_wall_clock(F.col("d"), F.col("h")), "d date, h string", rows)
    assert got == [dt.datetime(2024, 1, 2, 1, 10, 5), dt.datetime(2024, 1, 2, 0, 30), dt.datetime(2024, 1, 1, 9, 59)]
    assert one(spark, hms_seconds(F.col("h")), "h string", [("25:10:05",)]) == [90605]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_local_clock_ignores_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 2026-03-08 10:30 UTC is 03:30 PDT (after the spring-forward gap);
        # 2026-11-01 09:30 UTC is 01:30 PST (second pass through 01:xx).
        rows = [(1772965800,), (1793525400,), (1704096000,)]
        got = one(spark, local_wall_clock(F.col("u"), "America/Los_Angeles"), "u long", rows)
        secs = one(spark, local_epoch_seconds(F.col("u"), "America/Los_Angeles"), "u long", rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2026, 3, 8, 3, 30), dt.datetime(2026, 11, 1, 1, 30), dt.datetime(2024, 1, 1, 0, 0)]
    assert secs[2] == 1704067200


def test_circular_distance_wraps(spark):
    df = spark.createDataFrame([(86340, 60), (60, 86340 + 86400), (3600, 7200)], "a long, b long")
    got = [r[0] for r in df.select(circular_seconds_distance(F.col("a"), F.col("b"))).collect()]
    assert got == [120, 120, 3600]


def test_precipitation_buckets(spark):
    vals = [(None,), (0.0,), (0.99,), (1.0,), (4.99,), (5.0,), (-1.0,)]
    got = one(spark, precipitation_bucket(F.col("p")), "p double", vals)
    assert got == ["unknown", "dry", "light_rain", "moderate_rain", "moderate_rain", "heavy_rain", "heavy_rain"]


def test_delay_categories_and_offsets(spark):
    got = one(spark, delay_category(F.col("d")), "d long", [(-11,), (-10,), (0,), (5,), (15,), (30,), (60,)])
    assert got == ["Early >10min", "Early 0-10min", "On-time (0-5min)", "Minor delay (5-15min)",
                   "Moderate (15-30min)", "Major (30-60min)", "Severe >60min"]
    got = one(spark, offset_bucket(F.col("o")), "o int", [(0,), (1,), (5,), (6,), (10,), (11,)])
    assert got == ["0", "1-5", "1-5", "6-10", "6-10", "11+"]


def test_risk_steps(spark):
    assert one(spark, rain_step(F.col("p")), "p double", [(0.0,), (0.1,), (1.0,), (5.0,)]) == [0.0, 1.5, 3.0, 6.0]
    assert one(spark, wind_step(F.col("w")), "w double", [(19.0,), (20.0,), (34.0,), (35.0,)]) == [0.0, 1.0, 1.0, 2.0]
    assert one(spark, risk_level(F.col("x")), "x double", [(7.99,), (8.0,), (14.99,), (15.0,)]) == ["low", "medium", "medium", "high"]


def test_weather_time_formats(spark):
    rows = [("2024-01-01 05:06:07",), ("2024-01-01T05:06:07",), ("2024-01-01 05:06",), ("2024-01-01T05:06",),
            ("garbage",), ("2024-13-01 05:06",), (None,)]
    got = one(spark, parse_local_time(F.col("s")), "s string", rows)
    assert got[:4] == [dt.datetime(2024, 1, 1, 5, 6, 7)] * 2 + [dt.datetime(2024, 1, 1, 5, 6)] * 2
    assert got[4:] == [None, None, None]
    hours = one(spark, parse_local_hour(F.col("s")), "s string", rows)
    assert hours[:4] == [dt.datetime(2024, 1, 1, 5)] * 4 and hours[4:] == [None, None, None]
