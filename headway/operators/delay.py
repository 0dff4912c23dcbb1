"""Delay layer (local wall clock, minute delay) and its distribution checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import constants as K
from headway.functions.labels import delay_category
from headway.functions.numeric import count_when
from headway.functions.timefn import (
    local_epoch_seconds,
    minute_diff_seconds,
    scheduled_wall_seconds,
    wall_clock_from_seconds,
)

DELAY_COLUMNS = [
    "trip_id", "route_id", "direction_id", "service_id", "rt_seq", "rt_stop_id", "static_stop_id",
    "stop_name", "service_date_local", "actual_arrival_local_ts", "scheduled_arrival_local_ts", "delay_minutes",
]


def delay_layer(aligned: DataFrame, tz: str = K.DEFAULT_TZ, wrap: str | None = None) -> DataFrame:
    """Aligned rows -> delay rows in local time.

    Scheduled time is the arrival's local date plus H:MM:SS (a 24:30:00 stop
    reached after midnight is therefore a day early, as published).
    ``wrap='nearest_day'`` moves delays beyond +/-12 h by one day instead.
    Rows without an arrival or a scheduled time are dropped.
    """
    base = aligned.where(F.col("arrival_time_unix").isNotNull() & F.col("scheduled_arrival_hms").isNotNull())
    actual_s = local_epoch_seconds("arrival_time_unix", tz)
    base = base.withColumn("_actual_s", actual_s).withColumn(
        "_sched_s", scheduled_wall_seconds(F.col("_actual_s"), "scheduled_arrival_hms")
    )
    delay = minute_diff_seconds(F.col("_sched_s"), F.col("_actual_s"))
    if wrap == "nearest_day":
        delay = F.when(delay > 720, delay - 1440).when(delay < -720, delay + 1440).otherwise(delay)
    elif wrap is not None:
        raise ValueError(f"unknown wrap mode {wrap!r}")
    base = (
        base.withColumn("actual_arrival_local_ts", wall_clock_from_seconds(F.col("_actual_s")))
        .withColumn("service_date_local", F.to_date(F.col("actual_arrival_local_ts")))
        .withColumn("scheduled_arrival_local_ts", wall_clock_from_seconds(F.col("_sched_s")))
        .withColumn("delay_minutes", delay)
    )
    cols = list(DELAY_COLUMNS)
    if "best_offset" in aligned.columns:
        cols.insert(4, "best_offset")
    return base.select(*cols)


def delay_stats(delay: DataFrame) -> DataFrame:
    """One row: rows, trips, routes, min/max/avg/median delay."""
    d = F.col("delay_minutes")
    return delay.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("trip_id").alias("distinct_trips"),
        F.countDistinct("route_id").alias("distinct_routes"),
        F.min(d).alias("min_delay"),
        F.max(d).alias("max_delay"),
        F.avg(d).alias("avg_delay"),
        F.median(d).alias("median_delay"),
    )


def delay_outliers(delay: DataFrame) -> DataFrame:
    """One row: rows later than 60 min and earlier than -10 min."""
    d = F.col("delay_minutes")
    return delay.agg(
        count_when(d > K.SEVERE_LATE_MINUTES).alias("over_60_min"),
        count_when(d < K.EARLY_OUTLIER_MINUTES).alias("early_by_10_min"),
    )


def delay_distribution(delay: DataFrame) -> DataFrame:
    return delay.groupBy(delay_category(F.col("delay_minutes")).alias("delay_category")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def top_delays(delay: DataFrame, k: int = 10, worst: bool = True) -> DataFrame:
    """Worst (latest) or best (earliest) k delay rows, ties broken by trip and sequence."""
    first = F.desc("delay_minutes") if worst else F.asc("delay_minutes")
    return delay.orderBy(first, F.asc("trip_id"), F.asc("rt_seq")).limit(k).select(
        "trip_id", "route_id", "rt_seq", "stop_name", "delay_minutes",
        "scheduled_arrival_local_ts", "actual_arrival_local_ts",
    )
