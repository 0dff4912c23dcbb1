"""Delay KPIs of groups from one integer histogram per group.

Rows are counted per (group, trip, delay minute) with an ordinary partial aggregate; a trip then has
as many entries in a group as it has delay minutes there, and the first of them counts the trip.
Summed by (group, delay minute), that one table gives count, mean, exact interpolated quantiles,
rates and distinct trips.  The rows are read once; where they lie by trip, only the sums move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.labels import delayed, on_time
from headway.functions.numeric import pct, round_half

VALUE = "delay_minutes"


def _quantile(share: float) -> Column:
    """Interpolated quantile of the group, over rows that carry _before, _upto and _total."""
    position = (F.col("_total") - 1) * F.lit(share)
    value_at = lambda k: F.max(F.when((F.col("_before") <= k) & (k < F.col("_upto")), F.col(VALUE)))
    low, high = value_at(F.floor(position)), value_at(F.ceil(position))
    return low + (high - low) * F.max(position - F.floor(position))


def minute_counts(rows: DataFrame, keys: list[str], weight: Column | None = None) -> DataFrame:
    """Per group and delay minute: _n rows (by weight) and _trips, which add up to the group's distinct trips."""
    per_trip = rows.groupBy(*keys, "trip_id", VALUE).agg(F.sum(weight if weight is not None else F.lit(1)).alias("_n"))
    # a trip's first delay minute in a group counts the trip; one sort by trip, no list per trip
    of_trip = Window.partitionBy("trip_id", *keys).orderBy(F.asc_nulls_last(VALUE))
    first = F.when((F.row_number().over(of_trip) == 1) & F.col("trip_id").isNotNull(), 1).otherwise(0)
    return per_trip.withColumn("_first", first).groupBy(*keys, VALUE).agg(F.sum("_n").alias("_n"), F.sum("_first").alias("_trips"))


def kpis_of_counts(counted: DataFrame, keys: list[str]) -> DataFrame:
    """KPIs of groups from rows (keys, delay minute, _n), and trip_count where there is _trips."""
    known = F.when(F.col(VALUE).isNotNull(), F.col("_n"))
    ordered = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(VALUE)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # same order: one pass gives both sums
    placed = counted.withColumns({"_upto": F.sum(known).over(ordered), "_total": F.sum(known).over(whole)}).withColumn("_before", F.col("_upto") - F.col("_n"))
    n, value = F.sum("_n"), F.col(VALUE)
    share = lambda test: pct(F.sum(F.when(test, F.col("_n")).otherwise(0)), n)
    trips = [F.sum("_trips").alias("trip_count")] if "_trips" in counted.columns else []
    return placed.groupBy(*keys).agg(
        n.alias("stop_event_count"),
        round_half(F.sum(value * known) / F.sum(known), 2).alias("avg_delay_minutes"),
        round_half(_quantile(0.5), 2).alias("median_delay_minutes"),
        round_half(_quantile(0.95), 2).alias("p95_delay_minutes"),
        share(on_time(value)).alias("on_time_rate"),
        share(delayed(value)).alias("delay_probability_pct"),
        *trips,
    )


def delay_kpis(rows: DataFrame, keys: list[str], weight: Column | None = None) -> DataFrame:
    """Per group: stop_event_count, trip_count, mean, median, p95, on-time rate and delay probability.

    ``weight`` (default 1) is how many times a row counts; trips count once whatever the weight.
    """
    return kpis_of_counts(minute_counts(rows, keys, weight), keys)
