"""Analyst and dashboard extracts over the marts (top-k lists, headline numbers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.numeric import round_half
from headway.operators.frames import side_by_side
from headway.operators.kpi import n_rows


def top_k(df: DataFrame, order: list[Column], k: int, cols: list[str]) -> DataFrame:
    """ORDER BY ... LIMIT k (planned as TakeOrderedAndProject: per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k).select(*cols)


def hour_day_label(day: Column, hour: Column) -> Column:
    """'<day> HH:00'."""
    return F.concat(day, F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def route_hour_label(route: Column, ts: Column) -> Column:
    """'<route> @ yyyy-MM-dd HH:mm' from a TIMESTAMP_NTZ, built from its fields."""
    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    text = F.concat(
        F.year(ts).cast("string"), F.lit("-"), two(F.month(ts)), F.lit("-"), two(F.dayofmonth(ts)),
        F.lit(" "), two(F.hour(ts)), F.lit(":"), two(F.minute(ts)),
    )
    return F.concat(route, F.lit(" @ "), text)


def headline_metrics(route_perf: DataFrame) -> DataFrame:
    """Executive numbers: matched trips, unweighted route means, worst route values."""
    r4 = lambda c: round_half(c, 4)
    return route_perf.agg(
        F.sum("trip_count").cast("bigint").alias("total_trips_matched"),
        r4(F.avg("avg_delay_minutes")).alias("mean_route_avg_delay"),
        F.max("avg_delay_minutes").alias("worst_route_avg_delay"),
        F.min("on_time_rate").alias("worst_route_on_time_rate"),
        r4(F.median("median_delay_minutes")).alias("median_route_median_delay"),
        r4(F.avg("on_time_rate")).alias("mean_route_on_time_rate"),
    )


def alert_share_metrics(disruption: DataFrame) -> DataFrame:
    """Rows inside alert windows, their greatest share and the alert types, in one pass over the mart."""
    inside = lambda c: F.when(F.col("in_alert_window"), F.col(c))
    return disruption.agg(
        F.coalesce(F.sum(inside("stop_event_count")), F.lit(0)).cast("bigint").alias("rows_in_alert_windows"),
        F.coalesce(F.max(inside("pct_rows_associated_with_alerts")), F.lit(0.0)).alias("associated_share_pct"),
        F.countDistinct("alert_type").alias("alert_types_seen"),
    )


def risk_box_summary(risk: DataFrame) -> DataFrame:
    """Five-number summary of projected probability per risk level (linear quartiles)."""
    p = F.col("projected_delay_probability_pct")
    return risk.groupBy("risk_level").agg(
        n_rows().alias("periods"),
        F.min(p).alias("min_pct"),
        F.percentile(p, F.lit(0.25)).alias("q1_pct"),
        F.percentile(p, F.lit(0.5)).alias("median_pct"),
        F.percentile(p, F.lit(0.75)).alias("q3_pct"),
        F.max(p).alias("max_pct"),
    )


def route_list(stop_perf: DataFrame) -> DataFrame:
    """Distinct routes for a route filter, NULL dropped, sorted."""
    return stop_perf.select("route_id").where(F.col("route_id").isNotNull()).distinct().orderBy("route_id")


def filter_route(df: DataFrame, route: str | None) -> DataFrame:
    """Route filter where None or 'All' keeps every row."""
    if route is None or route == "All":
        return df
    return df.where(F.col("route_id") == route)


def input_readiness(
    route_perf: DataFrame,
    stop_perf: DataFrame,
    route_hour: DataFrame,
    weather_mart: DataFrame,
    route_weather: DataFrame,
    enriched: DataFrame,
) -> DataFrame:
    """Row counts and checks a dashboard needs before it can render."""
    required = ["coverage_rows", "coverage_trips", "pct_rt_rows_matched"]
    present = sum(1 for c in required if c in route_perf.columns)
    return side_by_side(
        route_perf.agg(n_rows().alias("route_performance_rows")),
        stop_perf.agg(
            n_rows().alias("stop_performance_rows"),
            F.countDistinct("route_id").alias("distinct_routes_in_stop_table"),
        ),
        route_hour.agg(n_rows().alias("route_hour_performance_rows")),
        weather_mart.agg(n_rows().alias("weather_impact_rows")),
        route_weather.agg(n_rows().alias("route_weather_impact_rows")),
        enriched.agg(F.count(F.when(F.col("is_raining"), 1)).alias("rainy_rows")),
    ).withColumn("coverage_cols_present", F.lit(present).cast("bigint"))


# Fixed column lists of the canned analyst queries (output contract).
ROUTE_RANKING_COLUMNS = ["route_id", "avg_delay_minutes", "p95_delay_minutes", "on_time_rate", "stop_event_count"]
STOP_RANKING_COLUMNS = ["stop_name", "route_id", "avg_delay_minutes", "median_delay_minutes", "on_time_rate", "stop_event_count"]
HOUR_DAY_COLUMNS = ["day_of_week", "hour_of_day", "route_id", "avg_delay_minutes", "delay_probability_pct", "stop_event_count"]
EVENT_COLUMNS = ["in_event_window", "event_type", "avg_delay_minutes", "delay_probability_pct", "stop_event_count"]
ALERT_COLUMNS = ["in_alert_window", "alert_type", "pct_rows_associated_with_alerts", "avg_delay_minutes", "delay_probability_pct", "stop_event_count"]
RISK_COLUMNS = ["forecast_hour_local_ts", "route_id", "projected_delay_minutes", "projected_delay_probability_pct", "risk_level", "precipitation_mm", "windspeed_kmh"]
