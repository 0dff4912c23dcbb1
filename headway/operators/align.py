"""Realtime-to-timetable sequence alignment (naive ordinal and best offset).

The feed's stop ids and sequence numbers do not match the timetable, so each
trip's observed rows are numbered by arrival time (rt_seq) and its timetable
rows by scheduled time (static_seq).  A trip observed from its k-th stop on
matches ``static_seq = rt_seq + k``; the offset k is chosen per trip by the
smallest timing error among 0 .. static_count - rt_count.

Plan shape: both sides are numbered by ``sequence_number`` (one shuffle each,
hot trips split); candidate rows are generated per observed row with
``explode(sequence(0, static_count - rt_count))`` so exactly the needed
(row, offset) pairs exist, then equi-joined to the timetable on
(trip_id, static_seq).  Scores aggregate per (trip, offset) with partial
aggregation; the best offset is a per-trip min over a struct (no window).
On trips of many offsets, ``search_best_offsets`` scores only those that exact
bounds leave (``offset_search``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.constants import DEFAULT_TZ
from headway.functions.timefn import (
    circular_seconds_distance,
    hms_seconds,
    local_epoch_seconds,
    minute_diff_seconds,
    scheduled_wall_seconds,
    utc_wall_clock,
)
from headway.operators.median import median_count_mean
from headway.operators.offset_search import offset_ranges, whole_ranges
from headway.operators.sequence import key_counts, sequence_number

SCORERS = ("median_minutes", "circular_seconds", "aligned_rows")


def _asc(*names: str) -> list[Column]:
    return [F.asc_nulls_last(n) for n in names]


def rt_sequence(rt_updates: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Number observed rows per trip by arrival (rt_seq) and count them (rt_count).

    Rows without a trip id are dropped: they can never join a trip.  By
    default every poll is kept, so repeated polls of a trip take consecutive
    positions (the published behaviour).  ``snapshot='latest_poll'`` keeps
    only the latest poll's row per (trip, stop).
    """
    rt = rt_updates.where(F.col("trip_id").isNotNull())
    if snapshot == "latest_poll":
        latest = rt.groupBy("trip_id", "stop_id").agg(F.max("poll_timestamp").alias("_latest"))
        rt = rt.join(latest, ["trip_id", "stop_id"]).where(F.col("poll_timestamp") == F.col("_latest")).drop("_latest")
    elif snapshot is not None:
        raise ValueError(f"unknown snapshot mode {snapshot!r}")
    order = _asc("arrival_time_unix", "stop_id", "departure_time_unix", "poll_timestamp")
    return sequence_number(rt, "trip_id", order, "rt_seq", "rt_count")


def static_sequence(stop_times: DataFrame, order_by: str = "string") -> DataFrame:
    """Number timetable rows per trip by scheduled arrival, departure.

    ``order_by='string'`` compares the H:MM:SS text (the published method:
    "9:59:00" sorts after "10:01:00"); ``'seconds'`` compares parsed seconds.
    """
    st = stop_times.where(F.col("trip_id").isNotNull())
    if order_by == "string":
        order = _asc("arrival_time", "departure_time", "stop_sequence", "stop_id")
    elif order_by == "seconds":
        order = [
            F.asc_nulls_last(hms_seconds("arrival_time")),
            F.asc_nulls_last(hms_seconds("departure_time")),
            *_asc("stop_sequence", "stop_id"),
        ]
    else:
        raise ValueError(f"unknown order_by {order_by!r}")
    return sequence_number(st, "trip_id", order, "static_seq", "static_count")


def offset_candidates(
    rt_updates: DataFrame, stop_times: DataFrame, trips: DataFrame | None = None
) -> DataFrame:
    """Trips eligible for offset search with their counts (one row per trip).

    Eligible: present in both sources, ``static_count >= rt_count`` (a trip
    with more observed rows than stops is dropped) and, when ``trips`` is
    given, present in the trips table.
    """
    rt_counts = key_counts(rt_updates.where(F.col("trip_id").isNotNull()), ["trip_id"], "rt_count")
    st_counts = key_counts(stop_times.where(F.col("trip_id").isNotNull()), ["trip_id"], "static_count")
    cand = rt_counts.join(st_counts, "trip_id").where(F.col("static_count") >= F.col("rt_count"))
    if trips is not None:
        cand = cand.join(trips.select("trip_id").where(F.col("trip_id").isNotNull()), "trip_id", "left_semi")
    return cand


def candidate_offsets(candidates: DataFrame) -> DataFrame:
    """One row per (trip, offset) with offset in 0 .. static_count - rt_count."""
    return candidates.select(
        "trip_id",
        "rt_count",
        "static_count",
        F.explode(F.sequence(F.lit(0), (F.col("static_count") - F.col("rt_count")).cast("int"))).alias("seq_offset"),
    )


def _candidate_rows(rt_seq: DataFrame, st_seq: DataFrame, ranges: DataFrame, st_cols: list[str]) -> DataFrame:
    rows = rt_seq.join(ranges, "trip_id").select("*", F.explode(F.sequence("first_offset", "last_offset")).alias("seq_offset"))
    rows = rows.withColumn("static_seq", F.col("rt_seq") + F.col("seq_offset"))
    return rows.join(st_seq.select("trip_id", "static_seq", *st_cols), ["trip_id", "static_seq"])


def score_offsets(
    rt_seq: DataFrame,
    st_seq: DataFrame,
    candidates: DataFrame,
    scorer: str = "median_minutes",
    tz: str = DEFAULT_TZ,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Score every candidate (trip, offset), or those in ``ranges`` (trip_id, first_offset, last_offset).

    * ``median_minutes``: median and mean of |minute_diff(scheduled, actual)|,
      scheduled = local service date of the arrival + H:MM:SS.
    * ``circular_seconds``: mean circular distance in seconds between the
      arrival's local second of day and the scheduled second of day.
    * ``aligned_rows``: number of aligned rows only.
    """
    ranges = whole_ranges(candidates) if ranges is None else ranges
    if scorer == "median_minutes":
        rows = _candidate_rows(rt_seq, st_seq, ranges, ["arrival_time"])
        actual = F.col("_actual_s")
        err = F.abs(minute_diff_seconds(scheduled_wall_seconds(actual, "arrival_time"), actual))
        rows = rows.withColumn("_actual_s", local_epoch_seconds("arrival_time_unix", tz)).select(
            "trip_id", "seq_offset", err.alias("_abs_err")
        )
        return median_count_mean(
            rows, ["trip_id", "seq_offset"], "_abs_err", "median_abs_error_min", "avg_abs_error_min", "aligned_rows"
        )
    if scorer == "circular_seconds":
        rows = _candidate_rows(rt_seq, st_seq, ranges, ["arrival_time"])
        dist = circular_seconds_distance(
            F.pmod(local_epoch_seconds("arrival_time_unix", tz), F.lit(86400)), hms_seconds("arrival_time")
        )
        return rows.groupBy("trip_id", "seq_offset").agg(
            F.count(F.lit(1)).alias("aligned_rows"),
            F.avg(dist).alias("avg_abs_diff_seconds"),
        )
    if scorer == "aligned_rows":
        rows = _candidate_rows(rt_seq, st_seq, ranges, [])
        return rows.groupBy("trip_id", "seq_offset").agg(F.count(F.lit(1)).alias("aligned_rows"))
    raise ValueError(f"unknown scorer {scorer!r}; expected one of {SCORERS}")


def best_offsets(scores: DataFrame, scorer: str = "median_minutes") -> DataFrame:
    """Keep the best offset per trip (ties -> lowest offset).

    A per-trip MIN over a struct whose fields spell the ranking, which
    aggregates partially before the shuffle (no window over a trip).
    """
    def isnull(c: str) -> Column:
        return F.col(c).isNull()

    if scorer == "median_minutes":
        rank = F.struct(
            isnull("median_abs_error_min").alias("m0"), F.col("median_abs_error_min").alias("m"),
            isnull("avg_abs_error_min").alias("a0"), F.col("avg_abs_error_min").alias("a"),
            F.col("seq_offset").alias("o"), F.col("aligned_rows").alias("r"),
        )
        best = scores.groupBy("trip_id").agg(F.min(rank).alias("b"))
        return best.select(
            "trip_id",
            F.col("b.o").alias("best_offset"),
            F.col("b.r").alias("aligned_rows"),
            F.col("b.m").alias("median_abs_error_min"),
            F.col("b.a").alias("avg_abs_error_min"),
        )
    if scorer == "circular_seconds":
        rank = F.struct(
            isnull("avg_abs_diff_seconds").alias("a0"), F.col("avg_abs_diff_seconds").alias("a"),
            (-F.col("aligned_rows")).alias("nr"), F.col("seq_offset").alias("o"),
        )
        best = scores.groupBy("trip_id").agg(F.min(rank).alias("b"))
        return best.select(
            "trip_id",
            F.col("b.o").alias("seq_offset"),
            (-F.col("b.nr")).alias("aligned_rows"),
            F.col("b.a").alias("avg_abs_diff_seconds"),
        )
    if scorer == "aligned_rows":
        rank = F.struct((-F.col("aligned_rows")).alias("nr"), F.col("seq_offset").alias("o"))
        best = scores.groupBy("trip_id").agg(F.min(rank).alias("b"))
        return best.select("trip_id", F.col("b.o").alias("seq_offset"), (-F.col("b.nr")).alias("aligned_rows"))
    raise ValueError(f"unknown scorer {scorer!r}")


def search_best_offsets(
    rt_seq: DataFrame, st_seq: DataFrame, candidates: DataFrame, tz: str = DEFAULT_TZ, whole: int | None = None
) -> DataFrame:
    """Best offset per trip by median minutes; on trips of many offsets only those that bounds leave are scored.

    The same rows as ``best_offsets(score_offsets(...))``, see ``offset_search``.
    """
    ranges = offset_ranges(rt_seq, st_seq, candidates, tz, whole)
    return best_offsets(score_offsets(rt_seq, st_seq, candidates, tz=tz, ranges=ranges))


def trip_meta(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", "route_id", "direction_id", "service_id").distinct()


def stop_meta(stops: DataFrame) -> DataFrame:
    return stops.select(F.col("stop_id").cast("string").alias("static_stop_id"), "stop_name").distinct()


def _aligned_columns(extra: list[Column]) -> list[Column]:
    return [
        F.col("trip_id"), F.col("route_id"), F.col("direction_id"), F.col("service_id"),
        *extra,
        F.col("rt_seq"), F.col("static_seq"),
        F.col("rt_stop_id"), F.col("static_stop_id"), F.col("stop_name"),
        F.col("arrival_time_unix"), F.col("departure_time_unix"),
        utc_wall_clock("arrival_time_unix").alias("actual_arrival_ts"),
        utc_wall_clock("departure_time_unix").alias("actual_departure_ts"),
        F.col("scheduled_arrival_hms"), F.col("scheduled_departure_hms"),
        F.col("poll_timestamp"),
    ]


def _rt_view(rt_seq: DataFrame) -> DataFrame:
    return rt_seq.select(
        "trip_id", F.col("stop_id").alias("rt_stop_id"), "arrival_time_unix", "departure_time_unix",
        "poll_timestamp", "rt_seq",
    )


def _st_view(st_seq: DataFrame) -> DataFrame:
    return st_seq.select(
        "trip_id", F.col("stop_id").cast("string").alias("static_stop_id"),
        F.col("arrival_time").alias("scheduled_arrival_hms"),
        F.col("departure_time").alias("scheduled_departure_hms"), "static_seq",
    )


def _with_meta(df: DataFrame, trips: DataFrame, stops: DataFrame) -> DataFrame:
    return df.join(trip_meta(trips), "trip_id", "left").join(stop_meta(stops), "static_stop_id", "left")


def align_ordinal(rt_seq: DataFrame, st_seq: DataFrame, trips: DataFrame, stops: DataFrame) -> DataFrame:
    """Naive alignment: the k-th observed row of a trip is its k-th stop."""
    joined = _rt_view(rt_seq).join(
        _st_view(st_seq).withColumnRenamed("static_seq", "rt_seq"), ["trip_id", "rt_seq"]
    ).withColumn("static_seq", F.col("rt_seq"))
    return _with_meta(joined, trips, stops).select(*_aligned_columns([]))


def align_with_offsets(
    rt_seq: DataFrame,
    st_seq: DataFrame,
    best: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    offset_col: str = "best_offset",
    carry: list[str] | None = None,
) -> DataFrame:
    """Join observed rows to the timetable at each trip's chosen offset."""
    carry = carry or []
    rt = _rt_view(rt_seq).join(best.select("trip_id", offset_col, *carry), "trip_id")
    rt = rt.withColumn("static_seq", F.col("rt_seq") + F.col(offset_col))
    joined = rt.join(_st_view(st_seq), ["trip_id", "static_seq"])
    return _with_meta(joined, trips, stops).select(*_aligned_columns([F.col(offset_col), *map(F.col, carry)]))


def align_best_offset(
    rt_updates: DataFrame,
    stop_times: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    scorer: str = "median_minutes",
    require_trip: bool = True,
    tz: str = DEFAULT_TZ,
    snapshot: str | None = None,
    order_by: str = "string",
) -> DataFrame:
    """Best-offset alignment end to end (one row per aligned observed row)."""
    rt_seq = rt_sequence(rt_updates, snapshot)
    st_seq = static_sequence(stop_times, order_by)
    cand = offset_candidates(rt_seq.select("trip_id"), stop_times, trips if require_trip else None)
    if scorer == "median_minutes":
        return align_with_offsets(rt_seq, st_seq, search_best_offsets(rt_seq, st_seq, cand, tz), trips, stops)
    best = best_offsets(score_offsets(rt_seq, st_seq, cand, scorer, tz), scorer)
    if scorer == "circular_seconds":
        best = best.select(
            "trip_id",
            F.col("seq_offset").alias("best_seq_offset"),
            F.col("aligned_rows").alias("offset_aligned_rows"),
            F.col("avg_abs_diff_seconds").alias("offset_avg_abs_diff_seconds"),
        )
        return align_with_offsets(
            rt_seq, st_seq, best, trips, stops, "best_seq_offset",
            ["offset_aligned_rows", "offset_avg_abs_diff_seconds"],
        )
    best = best.withColumnRenamed("seq_offset", "best_offset")
    return align_with_offsets(rt_seq, st_seq, best, trips, stops)
