"""Window marts by slices of time: rows are merged with the windows' steps, no join on instants."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.functions.timefn import hms_seconds, wall_micros, wall_seconds
from headway.operators.extracts import alert_share_metrics
from headway.operators.windows import covered_rows, interval_join_theta

T = dt.datetime
ROWS = "trip_id string, rt_seq int, delay_minutes long, actual_arrival_local_ts timestamp_ntz"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark):
    rng = random.Random(12)
    base = T(2024, 1, 1)
    at = lambda: base + dt.timedelta(seconds=rng.choice([600, 60, 1]) * rng.randrange(300), microseconds=rng.choice([0, 0, 1]))
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(9), rng.choice([at(), at(), at(), None])) for i in range(400)]
    rows += [("long", 1, 0, base + dt.timedelta(days=40)), ("early", 1, 0, T(1969, 12, 31, 23, 59, 59, 999_999))]
    wins = [("o1", "n", "x", "r", T(1969, 12, 31), T(1970, 1, 1), "s"), ("o2", "n", "y", "r", base, base + dt.timedelta(days=41), "s")]
    for i in range(80):
        start = at()
        end = rng.choice([start, start + dt.timedelta(seconds=rng.choice([-5, 1, 600, 7_200])), None])
        wins.append((f"e{i}", "n", rng.choice(["x", "y", None]), "r", start, end, "s"))
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(wins, schemas.EVENT_WINDOWS)


@pytest.mark.parametrize("hot_rows", ["2000000", "1"])  # 1: every slice is hot, instants get their coverage by ranges
def test_rows_merged_with_steps_equal_the_theta_join(spark, hot_rows):
    rows, windows = tables(spark)
    joined = interval_join_theta(rows, windows, "actual_arrival_local_ts")
    inside = F.col("event_id").isNotNull()
    kind = F.coalesce("event_type", F.lit("none"))
    keys = ["trip_id", "rt_seq", "delay_minutes"]
    want = joined.groupBy(*keys, kind.alias("event_type"), inside.alias("flag")).count()
    spark.conf.set("headway.skew.hotKeyRows", hot_rows)
    try:
        got = covered_rows(rows, windows, "event_type", "flag").select(*keys, "event_type", "flag", "n")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        spark.conf.unset("headway.skew.hotKeyRows")


def test_rows_do_not_meet_instants_again(spark):
    plan = plan_of(covered_rows(*tables(spark), "event_type", "flag"))
    assert "collect_list" not in plan and "Join" not in plan and "Window" in plan


def test_alert_share_reads_the_mart_once(spark):
    data = [("police", True, 3, 30.0), ("police", False, 7, 0.0), (None, True, 2, 50.0), ("none", False, 4, 0.0)]
    cols = "alert_type string, in_alert_window boolean, stop_event_count long, pct_rows_associated_with_alerts double"
    share = alert_share_metrics(spark.createDataFrame(data, cols))
    assert [tuple(r) for r in share.collect()] == [(5, 50.0, 2)]
    assert plan_of(share).split("== Initial Plan ==")[0].count("Scan ExistingRDD") == 1
    assert [tuple(r) for r in alert_share_metrics(spark.createDataFrame([], cols)).collect()] == [(0, 0.0, 0)]


def test_wall_clock_numbers(spark):
    times = [T(1969, 12, 31, 23, 59, 59, 500_000), T(2024, 3, 10, 2, 30, 1, 999_999), T(1600, 2, 3, 4, 5, 6, 7), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    micros = [None if t is None else (t - T(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in times]
    got = df.select(wall_micros("t").alias("m"), wall_seconds("t").alias("s")).collect()
    assert [(r.m, r.s) for r in got] == [(m, None if m is None else m // 1_000_000) for m in micros]
    hms = spark.createDataFrame([("25:00:01",), ("9:05:07",), (None,)], "h string").select(hms_seconds("h")).collect()
    assert [r[0] for r in hms] == [90_001, 32_707, None]
