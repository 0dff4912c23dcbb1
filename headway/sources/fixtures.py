"""Transit inputs derived from the provided TPC-H-style tables.

Mapping (documented in FIXTURES.md): an order is a trip; its line items,
numbered by line number, are the timetable stops; the realtime feed observes
a contiguous part of each trip (the order status sets how many leading stops
are missed, two order priorities miss the last stop) with a per-trip delay and
per-stop noise; hourly weather and event/alert windows come from ``events``.  Every
table is derived from whole inputs, so all downstream work grows with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.timefn import trunc_hour
from headway.operators.sequence import sequence_number

# Parameters of the derivation (shared with the DuckDB oracle text).
FEED_EPOCH = 1704096000            # 2024-01-01 00:00 America/Los_Angeles, in unix seconds
UNLISTED_SINCE = "2001-01-01"      # feeds of orders dated from then on carry an id that no timetable lists
LATE_EVERY, LATE_SECONDS = 41, 4500  # every so many trips run so much later
TAIL_DROP_PRIORITIES = ("2-HIGH", "4-NOT SPECIFIED")  # feeds of these orders miss the last stop
AS_OF = "2024-01-15 06:00:00"      # forecast start hour used by the registered queries


@dataclass(frozen=True)
class TransitTables:
    trips: DataFrame
    stops: DataFrame
    routes: DataFrame
    stop_times: DataFrame
    rt_updates: DataFrame
    weather: DataFrame
    event_windows: DataFrame
    alert_windows: DataFrame
    # Catalog database holding these tables when they were persisted (raw layer).
    source_key: str | None = None


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _hms(secs: Column) -> Column:
    return F.concat_ws(
        ":", _two(F.floor(secs / 3600)), _two(F.floor(F.pmod(secs, F.lit(3600)) / 60)), _two(F.pmod(secs, F.lit(60)))
    )


def _weather_time(ts: Column) -> Column:
    """A whole hour in one of the four accepted layouts, by turns: with "T" or a blank, with seconds or without."""
    return F.concat(
        F.year(ts).cast("string"), F.lit("-"), _two(F.month(ts)), F.lit("-"), _two(F.dayofmonth(ts)),
        F.when(F.pmod(F.hour(ts), F.lit(2)) == 0, F.lit("T")).otherwise(F.lit(" ")),
        _two(F.hour(ts)), F.lit(":"), _two(F.minute(ts)),
        F.when(F.pmod(F.hour(ts), F.lit(4)) >= 2, F.lit(":00")).otherwise(F.lit("")),
    )


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0).cast("decimal(18,6)"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by trip: trip_id, k, p, s, n."""
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.col("l_orderkey").alias("k"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        F.col("l_linenumber").alias("n"),
    )


def stop_lines(spark: SparkSession, sf_dir: str, hot: bool | None = None) -> DataFrame:
    """Line items numbered within their order: trip_id, k, p, s, n, pos, cnt, a, d; ``hot``: whether an order is hot, if that is known."""
    line = sequence_number(order_lines(spark, sf_dir), "trip_id", [F.col("n"), F.col("p"), F.col("s")], "pos", "cnt", force_split=hot)
    base = F.lit(18000) + F.pmod(F.col("k"), F.lit(76)) * 900 + F.col("pos") * 240
    return line.withColumn("a", base).withColumn("d", base + 30)


def load_transit(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> TransitTables:
    """Derive the transit tables; ``lines`` may be a persisted ``stop_lines`` result."""
    orders = _read(spark, sf_dir, "orders")
    trips = orders.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_orderpriority").alias("route_id"),
        F.pmod(F.col("o_orderkey"), F.lit(2)).cast("int").alias("direction_id"),
        F.col("o_orderstatus").alias("service_id"),
    )
    routes = orders.select(F.col("o_orderpriority").alias("route_id")).distinct()
    stops = _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("stop_id"),
        F.concat(F.lit("R"), F.col("s_suppkey").cast("string"), F.lit("-1")).alias("stop_code"),
        F.col("s_name").alias("stop_name"),
    )

    sched = lines if lines is not None else stop_lines(spark, sf_dir)
    stop_times = sched.select(
        "trip_id",
        F.col("s").cast("string").alias("stop_id"),
        _hms(F.col("a")).alias("arrival_time"),
        _hms(F.col("d")).alias("departure_time"),
        F.col("pos").cast("int").alias("stop_sequence"),
    )

    k, n, p = F.col("k"), F.col("n"), F.col("p")
    # How much of a trip the feed observes comes from the order's own fields:
    # leading stops missed by status, last stop missing for two priorities.
    observed = orders.select(
        F.col("o_orderkey").cast("string").alias("_trip"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0))
        .when(F.col("o_orderstatus") == "O", F.lit(1))
        .otherwise(F.lit(2)).alias("head_skip"),
        F.when(F.col("o_orderpriority").isin(*TAIL_DROP_PRIORITIES), F.lit(1)).otherwise(F.lit(0)).alias("tail_drop"),
        (F.col("o_orderdate") >= F.lit(UNLISTED_SINCE).cast("timestamp_ntz")).alias("unlisted"),
        F.col("o_orderpriority").alias("priority"),
    )
    sched = sched.join(observed, sched["trip_id"] == observed["_trip"]).drop("_trip")
    head_skip, tail_drop = F.col("head_skip"), F.col("tail_drop")
    shift = F.pmod(k, F.lit(30)) * 86400 + F.col("a") + (F.pmod(k * 7, F.lit(900)) - 180) + F.pmod(p, F.lit(120))
    shift = shift + F.when(F.pmod(k, F.lit(LATE_EVERY)) == 0, F.lit(LATE_SECONDS)).otherwise(F.lit(0))
    poll = F.concat(F.lit("2024-01-"), _two(F.pmod(k, F.lit(30)) + 1), F.lit("T00:00:00+00:00"))
    rt_updates = sched.where((F.col("pos") > head_skip) & (F.col("pos") <= F.col("cnt") - tail_drop)).select(
        F.when(F.col("unlisted"), F.concat(F.lit("U"), F.col("trip_id"))).otherwise(F.col("trip_id")).alias("trip_id"),
        F.when(F.pmod(k, F.lit(4)) != 0, F.col("priority")).alias("route_id"),
        F.when(F.pmod(n, F.lit(3)) == 0, F.col("s").cast("string"))
        .otherwise(F.concat(F.lit("R"), F.col("s").cast("string"), F.lit("-"), F.pmod(n, F.lit(3)).cast("string")))
        .alias("stop_id"),
        (F.col("pos") - head_skip).cast("int").alias("stop_sequence"),
        F.when(F.pmod(k + n, F.lit(97)) == 0, F.lit(None)).otherwise(F.lit(FEED_EPOCH) + shift).cast("bigint").alias("arrival_time_unix"),
        F.when(F.pmod(k + n, F.lit(89)) == 0, F.lit(None)).otherwise(F.lit(FEED_EPOCH + 30) + shift).cast("bigint").alias("departure_time_unix"),
        poll.alias("poll_timestamp"),
        poll.alias("loaded_at"),
    )

    events = _read(spark, sf_dir, "events")
    ev_hour = events.groupBy(trunc_hour(F.col("ts")).alias("h")).agg(F.sum("event_id").cast("bigint").alias("e"))
    e = F.col("e")
    weather = ev_hour.select(
        _weather_time(F.col("h")).alias("observation_datetime"),
        F.when(F.pmod(e, F.lit(7)) == 1, F.lit(0.4))
        .when(F.pmod(e, F.lit(7)) == 2, F.lit(2.0))
        .when(F.pmod(e, F.lit(7)) == 3, F.lit(7.0))
        .otherwise(F.lit(0.0))
        .alias("precipitation_mm"),
        (F.lit(8.0) + F.pmod(e, F.lit(15))).cast("double").alias("temperature_c"),
        F.pmod(e, F.lit(45)).cast("double").alias("windspeed_kmh"),
        F.lit(37.7749).alias("latitude"),
        F.lit(-122.4194).alias("longitude"),
        F.lit("2024-02-01T00:00:00+00:00").alias("loaded_at"),
    )

    event_windows = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("event_name"),
        F.when(F.pmod(F.col("user_id"), F.lit(3)) == 0, F.lit("concert"))
        .when(F.pmod(F.col("user_id"), F.lit(3)) == 1, F.lit("sports"))
        .otherwise(F.lit("festival"))
        .alias("event_type"),
        F.lit("bay").alias("region"),
        F.col("ts").alias("window_start_local_ts"),
        _plus_minutes(F.col("ts"), F.lit(30) + F.pmod(F.col("event_id"), F.lit(180))).alias("window_end_local_ts"),
        F.lit("medium").alias("severity"),
    )
    alert_windows = events.where(F.col("event_type") == "error").select(
        F.col("event_id").cast("string").alias("alert_id"),
        F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit("equipment")).otherwise(F.lit("police")).alias("alert_type"),
        F.lit("bay").alias("region"),
        F.col("ts").alias("window_start_local_ts"),
        _plus_minutes(F.col("ts"), F.lit(15) + F.pmod(F.col("event_id"), F.lit(90))).alias("window_end_local_ts"),
        F.lit("minor").alias("severity"),
    )
    return TransitTables(trips, stops, routes, stop_times, rt_updates, weather, event_windows, alert_windows)
