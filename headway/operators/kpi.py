"""Route, stop and route-hour KPI marts and the unmatched-trip audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import constants as K
from headway.functions.numeric import pct
from headway.functions.timefn import local_wall_clock
from headway.operators.histogram import delay_kpis

def n_rows() -> Column:
    return F.count(F.lit(1))


def observed_rows_by_trip_route(rt_updates: DataFrame, trips: DataFrame) -> DataFrame:
    """Observed rows with an arrival, joined to the trips table for their route."""
    rt = rt_updates.where(F.col("arrival_time_unix").isNotNull() & F.col("trip_id").isNotNull())
    return rt.select("trip_id", "arrival_time_unix").join(trips.select("trip_id", "route_id"), "trip_id")


def route_performance(delay: DataFrame, rt_updates: DataFrame, trips: DataFrame) -> DataFrame:
    raw = observed_rows_by_trip_route(rt_updates, trips).groupBy("route_id").agg(n_rows().alias("raw_rt_rows"))
    matched = delay_kpis(delay, ["route_id"])
    # Both sides are per-route aggregates; AQE picks the join at runtime.
    m, r = matched.alias("m"), raw.alias("r")
    return m.join(r, F.col("m.route_id") == F.col("r.route_id"), "left").select(
        F.col("m.route_id").alias("route_id"),
        "trip_count", "stop_event_count", "avg_delay_minutes", "median_delay_minutes",
        "p95_delay_minutes", "on_time_rate",
        F.col("stop_event_count").alias("coverage_rows"),
        F.col("trip_count").alias("coverage_trips"),
        pct(F.col("stop_event_count"), F.col("raw_rt_rows")).alias("pct_rt_rows_matched"),
    )


def stop_performance(delay: DataFrame, route_perf: DataFrame) -> DataFrame:
    """Per (stop, stop name, route) delay KPIs with the route's coverage.

    Coverage columns depend on the route only, so the delay rows are
    aggregated first and the per-route coverage joins the small result
    (never shuffle the delay layer on a handful of route keys).
    """
    return with_route_coverage(delay_kpis(delay, ["static_stop_id", "stop_name", "route_id"]), route_perf)


def with_route_coverage(grouped: DataFrame, route_perf: DataFrame) -> DataFrame:
    """The stop mart from the KPIs of its groups and the route mart."""
    cov = route_perf.select(
        F.col("route_id").alias("_rc_route"), "coverage_rows", "coverage_trips", "pct_rt_rows_matched"
    )
    joined = grouped.join(cov, grouped["route_id"] == cov["_rc_route"], "left")
    return joined.select(
        "static_stop_id", "stop_name", "route_id", "stop_event_count", "avg_delay_minutes",
        "median_delay_minutes", "on_time_rate",
        F.coalesce("coverage_rows", F.lit(0).cast("bigint")).alias("coverage_rows"),
        F.coalesce("coverage_trips", F.lit(0).cast("bigint")).alias("coverage_trips"),
        F.coalesce("pct_rt_rows_matched", F.lit(0.0)).alias("pct_rt_rows_matched"),
    )


def route_hour_performance(
    delay: DataFrame, rt_updates: DataFrame, trips: DataFrame, tz: str = K.DEFAULT_TZ
) -> DataFrame:
    raw = (
        observed_rows_by_trip_route(rt_updates, trips)
        .groupBy("route_id", F.hour(local_wall_clock("arrival_time_unix", tz)).cast("bigint").alias("hour_of_day"))
        .agg(n_rows().alias("raw_rt_rows"))
    )
    by_hour = delay.withColumn("hour_of_day", F.hour("actual_arrival_local_ts").cast("bigint"))
    matched = delay_kpis(by_hour, ["route_id", "hour_of_day"])
    # Both sides are per-route aggregates; AQE picks the join at runtime.
    m, r = matched.alias("m"), raw.alias("r")
    on = (F.col("m.route_id") == F.col("r.route_id")) & (F.col("m.hour_of_day") == F.col("r.hour_of_day"))
    return m.join(r, on, "left").select(
        F.col("m.route_id").alias("route_id"),
        F.col("m.hour_of_day").alias("hour_of_day"),
        "stop_event_count", "trip_count", "avg_delay_minutes", "median_delay_minutes", "on_time_rate",
        F.col("stop_event_count").alias("coverage_rows"),
        F.col("trip_count").alias("coverage_trips"),
        pct(F.col("stop_event_count"), F.col("raw_rt_rows")).alias("pct_rt_rows_matched"),
    )


def unmatched_trips(rt_updates: DataFrame, delay: DataFrame) -> DataFrame:
    """Observed trips with no row in the delay layer, with poll span."""
    matched = delay.select("trip_id").where(F.col("trip_id").isNotNull()).distinct()
    rt = rt_updates.where(F.col("trip_id").isNotNull())
    return (
        rt.join(matched, "trip_id", "left_anti")
        .groupBy("trip_id")
        .agg(
            n_rows().alias("raw_row_count"),
            F.min("poll_timestamp").alias("first_poll_ts"),
            F.max("poll_timestamp").alias("last_poll_ts"),
        )
    )
