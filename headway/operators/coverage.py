"""Coverage of the delay layer against the raw feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.labels import offset_bucket
from headway.functions.numeric import count_when, pct, pct_or_zero, round_half
from headway.operators.frames import side_by_side
from headway.operators.kpi import n_rows, observed_rows_by_trip_route


def coverage_summary(rt_updates: DataFrame, delay: DataFrame, require_arrival: bool = True) -> DataFrame:
    """One row: raw vs matched rows and trip ids.

    ``require_arrival=True`` counts raw rows with an arrival only and NULL
    percentages on empty input (audit form); False counts every raw row and
    gives 0 on empty input (dashboard form).
    """
    raw = rt_updates.where(F.col("arrival_time_unix").isNotNull()) if require_arrival else rt_updates
    raw_rows = raw.agg(n_rows().alias("total_raw_rt_rows"))
    raw_trips = rt_updates.where(F.col("trip_id").isNotNull()).agg(F.countDistinct("trip_id").alias("raw_trip_ids"))
    matched = delay.agg(n_rows().alias("matched_rt_rows"), F.countDistinct("trip_id").alias("matched_trip_ids"))
    s = side_by_side(raw_rows, raw_trips, matched)
    ratio = pct if require_arrival else pct_or_zero
    return s.select(
        "total_raw_rt_rows",
        "matched_rt_rows",
        (F.col("total_raw_rt_rows") - F.col("matched_rt_rows")).alias("unmatched_rt_rows"),
        ratio(F.col("matched_rt_rows"), F.col("total_raw_rt_rows")).alias("pct_rt_rows_matched"),
        "raw_trip_ids",
        "matched_trip_ids",
        (F.col("raw_trip_ids") - F.col("matched_trip_ids")).alias("unmatched_trip_ids"),
        ratio(F.col("matched_trip_ids"), F.col("raw_trip_ids")).alias("pct_trip_ids_matched"),
    )


def offset_distribution(delay: DataFrame) -> DataFrame:
    """Rows and trips per best-offset bucket with each bucket's share of rows."""
    agg = delay.groupBy(offset_bucket(F.col("best_offset")).alias("offset_bucket")).agg(
        n_rows().alias("row_count"), F.countDistinct("trip_id").alias("trip_count")
    )
    # At most four rows remain, so the unpartitioned window is trivial.
    total = F.sum("row_count").over(Window.partitionBy())
    return agg.withColumn("pct_rows", round_half(F.lit(100.0) * F.col("row_count") / total, 1))


def route_offset_usage(delay: DataFrame, k: int = 10) -> DataFrame:
    """Top-k routes by share of rows aligned with a non-zero offset."""
    nz = F.col("best_offset") > 0
    agg = delay.groupBy("route_id").agg(
        n_rows().alias("matched_rows"),
        round_half(F.avg("best_offset"), 2).alias("avg_best_offset"),
        count_when(nz).alias("nonzero_offset_rows"),
        pct(count_when(nz), n_rows()).alias("pct_nonzero_offset_rows"),
    )
    return agg.orderBy(
        F.desc_nulls_last("pct_nonzero_offset_rows"), F.desc_nulls_last("avg_best_offset"),
        F.desc("matched_rows"), F.asc_nulls_last("route_id"),
    ).limit(k)


def route_coverage(rt_updates: DataFrame, trips: DataFrame, delay: DataFrame, k: int | None = 10) -> DataFrame:
    """Routes with the lowest share of raw rows matched (raw side preserved)."""
    raw = observed_rows_by_trip_route(rt_updates, trips).groupBy("route_id").agg(
        n_rows().alias("raw_rt_rows"), F.countDistinct("trip_id").alias("raw_trip_ids")
    )
    matched = delay.groupBy(F.col("route_id").alias("_m_route")).agg(
        n_rows().alias("_m_rows"), F.countDistinct("trip_id").alias("_m_trips")
    )
    j = raw.join(matched, raw["route_id"] == matched["_m_route"], "left")
    mrows = F.coalesce("_m_rows", F.lit(0).cast("bigint"))
    mtrips = F.coalesce("_m_trips", F.lit(0).cast("bigint"))
    out = j.select(
        "route_id",
        "raw_rt_rows",
        mrows.alias("matched_rows"),
        (F.col("raw_rt_rows") - mrows).alias("unmatched_rows"),
        pct(mrows, F.col("raw_rt_rows")).alias("pct_rows_matched"),
        "raw_trip_ids",
        mtrips.alias("matched_trip_ids"),
        pct(mtrips, F.col("raw_trip_ids")).alias("pct_trip_ids_matched"),
    )
    if k is None:
        return out
    return out.orderBy(
        F.asc_nulls_last("pct_rows_matched"), F.desc("raw_rt_rows"), F.asc_nulls_last("route_id")
    ).limit(k)


def excluded_trip_count(rt_updates: DataFrame, delay: DataFrame) -> DataFrame:
    """Distinct raw trip ids EXCEPT distinct delay-layer trip ids, counted."""
    raw = rt_updates.where(F.col("trip_id").isNotNull()).select("trip_id").distinct()
    kept = delay.select("trip_id").distinct()
    return raw.subtract(kept).agg(n_rows().alias("excluded_trip_count"))
