"""Data-quality audits: key overlap, uniqueness, profiles, reconciliation, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.numeric import count_when, round_half, sum_when
from headway.operators.frames import side_by_side
from headway.operators.kpi import n_rows


def key_overlap(left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str, str]) -> DataFrame:
    """Distinct key sets of two frames and the size of their intersection (one row)."""
    l_keys = left.select(*keys).distinct()
    r_keys = right.select(*keys).distinct()
    left_n, right_n, both_n = names
    matched = l_keys.join(r_keys, keys).agg(n_rows().alias(both_n))
    return side_by_side(l_keys.agg(n_rows().alias(left_n)), r_keys.agg(n_rows().alias(right_n)), matched).select(
        left_n, right_n, both_n
    )


def alternate_key_matches(rt_updates: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct observed stop ids that equal some timetable stop_code."""
    codes = stops.select(F.col("stop_code").alias("stop_id")).where(F.col("stop_id").isNotNull()).distinct()
    ids = rt_updates.select("stop_id").distinct()
    return ids.join(codes, "stop_id").agg(n_rows().alias("matched_on_stop_code"))


def pair_uniqueness(stop_times: DataFrame) -> DataFrame:
    pairs = stop_times.groupBy("trip_id", "stop_id").agg(n_rows().alias("row_count"))
    return pairs.agg(
        n_rows().alias("total_pairs"),
        sum_when(F.col("row_count") == 1).alias("unique_pairs"),
        sum_when(F.col("row_count") > 1).alias("duplicate_pairs"),
    )


def duplicate_pairs(stop_times: DataFrame, k: int = 20) -> DataFrame:
    dup = stop_times.groupBy("trip_id", "stop_id").agg(n_rows().alias("row_count")).where(F.col("row_count") > 1)
    return dup.orderBy(F.desc("row_count"), F.asc("trip_id"), F.asc("stop_id")).limit(k)


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct ``key`` values of ``left`` with no equal value in ``right`` (NULL never matches)."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def schedule_lookup(rt_updates: DataFrame, trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Observed rows with their route and the timetable row of the same (trip, stop)."""
    r = rt_updates.select("trip_id", "stop_id")
    t = trips.select("trip_id", "route_id")
    s = stop_times.select("trip_id", "stop_id", "arrival_time", "departure_time")
    return r.join(t, "trip_id", "left").join(s, ["trip_id", "stop_id"], "left").select(
        "trip_id", "stop_id", "route_id", "arrival_time", "departure_time"
    )


def sequence_count_match(rt_updates: DataFrame, stop_times: DataFrame) -> DataFrame:
    rc = rt_updates.groupBy("trip_id").agg(n_rows().alias("rt_count"))
    sc = stop_times.groupBy("trip_id").agg(n_rows().alias("static_count"))
    return rc.join(sc, "trip_id").select(
        "trip_id", "rt_count", "static_count", (F.col("rt_count") == F.col("static_count")).alias("exact_match")
    )


def sequence_view(rt_seq: DataFrame, st_seq: DataFrame, stops: DataFrame, trip_ids: list[str] | None = None) -> DataFrame:
    """Every timetable stop of the trips next to the observed row with the same ordinal."""
    st = st_seq.select("trip_id", "static_seq", F.col("stop_id").alias("static_stop_id"))
    rt = rt_seq.select(
        "trip_id", F.col("rt_seq").alias("static_seq"), F.col("stop_id").alias("rt_stop_id"),
        "arrival_time_unix", "departure_time_unix",
    )
    if trip_ids is not None:
        st = st.where(F.col("trip_id").isin(trip_ids))
        rt = rt.where(F.col("trip_id").isin(trip_ids))
    names = stops.select(F.col("stop_id").alias("static_stop_id"), "stop_name")
    return st.join(rt, ["trip_id", "static_seq"], "left").join(names, "static_stop_id", "left").select(
        "trip_id", "static_seq", "static_stop_id", "stop_name", "rt_stop_id", "arrival_time_unix", "departure_time_unix"
    )


def rt_profile(rt_updates: DataFrame) -> DataFrame:
    """Distinct and NULL counts of the observed feed in a single pass."""
    def nulls(c: str):
        return count_when(F.col(c).isNull())

    return rt_updates.agg(
        n_rows().alias("total_rows"),
        F.countDistinct("trip_id").alias("distinct_trip_ids"),
        F.countDistinct("route_id").alias("distinct_route_ids"),
        nulls("route_id").alias("null_route_ids"),
        nulls("stop_id").alias("null_stop_ids"),
        nulls("arrival_time_unix").alias("null_arrival_time_unix"),
        nulls("departure_time_unix").alias("null_departure_time_unix"),
    )


def frequency(df: DataFrame, col: str, k: int = 20) -> DataFrame:
    """Top-k values of ``col`` by row count."""
    return df.groupBy(col).agg(n_rows().alias("row_count")).orderBy(
        F.desc("row_count"), F.asc_nulls_last(col)
    ).limit(k)


def load_summary(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Per table: row count and min/max of a time column (as text)."""
    parts = []
    for name, (df, col) in tables.items():
        c = F.col(col).cast("string") if col else F.lit(None).cast("string")
        parts.append(
            df.agg(n_rows().alias("row_count"), F.min(c).alias("min_ts"), F.max(c).alias("max_ts")).select(
                F.lit(name).alias("table_name"), "row_count", "min_ts", "max_ts"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def column_presence(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns missing from ``df`` (schema only, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def mart_reconciliation(delay: DataFrame, marts: dict[str, DataFrame]) -> DataFrame:
    """Each mart's summed stop_event_count against the delay-layer row count."""
    sums = [m.agg(F.sum("stop_event_count").cast("bigint").alias("total_events")).select(
        F.lit(name).alias("mart_name"), "total_events") for name, m in marts.items()]
    expected = delay.agg(n_rows().alias("total_events")).select(F.lit(None).cast("string").alias("mart_name"), "total_events")
    allrows = reduce(DataFrame.unionByName, [*sums, expected])
    exp = F.max(F.when(F.col("mart_name").isNull(), F.col("total_events"))).over(Window.partitionBy())
    return allrows.withColumn("delay_rows", exp).where(F.col("mart_name").isNotNull()).withColumn(
        "reconciled", F.col("total_events") == F.col("delay_rows")
    )


def mart_null_audit(route_perf: DataFrame) -> DataFrame:
    return route_perf.agg(
        count_when(F.col("route_id").isNull()).alias("null_route_id"),
        count_when(F.col("avg_delay_minutes").isNull()).alias("null_avg_delay"),
        count_when(F.col("on_time_rate").isNull()).alias("null_on_time_rate"),
    )


def route_mart_summary(route_perf: DataFrame) -> DataFrame:
    a = F.col("avg_delay_minutes")
    return route_perf.agg(
        n_rows().alias("route_count"),
        round_half(F.avg(a), 2).alias("mean_avg_delay"),
        round_half(F.max(a), 2).alias("worst_route_avg_delay"),
        round_half(F.min(a), 2).alias("best_route_avg_delay"),
        round_half(F.avg("on_time_rate"), 1).alias("mean_on_time_rate"),
        F.sum("stop_event_count").cast("bigint").alias("total_stop_events"),
    )


def stop_mart_summary(stop_perf: DataFrame) -> DataFrame:
    a = F.col("avg_delay_minutes")
    return stop_perf.agg(
        n_rows().alias("route_stop_combinations"),
        F.countDistinct("static_stop_id").alias("unique_stops"),
        F.countDistinct("route_id").alias("routes_in_stop_table"),
        round_half(F.avg(a), 2).alias("mean_avg_delay"),
        round_half(F.max(a), 2).alias("worst_stop_avg_delay"),
        F.sum("stop_event_count").cast("bigint").alias("total_stop_events"),
    )


def hour_mart_summary(route_hour: DataFrame) -> DataFrame:
    a = F.col("avg_delay_minutes")
    return route_hour.agg(
        n_rows().alias("route_hour_combinations"),
        F.countDistinct("route_id").alias("routes_in_hour_table"),
        F.countDistinct("hour_of_day").alias("hours_covered"),
        round_half(F.avg(a), 2).alias("mean_avg_delay"),
        round_half(F.max(a), 2).alias("peak_hour_avg_delay"),
        round_half(F.min(a), 2).alias("best_hour_avg_delay"),
    )


def alignment_summary(aligned: DataFrame) -> DataFrame:
    return aligned.agg(
        n_rows().alias("total_rows"),
        F.countDistinct("trip_id").alias("distinct_trip_ids"),
        F.countDistinct("route_id").alias("distinct_route_ids"),
        count_when(F.col("route_id").isNull()).alias("null_route_ids"),
        F.countDistinct(F.when(F.col("best_offset") != 0, F.col("trip_id"))).alias("trips_with_nonzero_offset"),
    )


def rows_per_group(aligned: DataFrame, keys: list[str]) -> DataFrame:
    return aligned.groupBy(*keys).agg(n_rows().alias("aligned_rows"))
