"""Exact interpolated median for many small groups, via a value histogram.

``percentile``/``median`` keep an object buffer per group, which is slow when
there are hundreds of thousands of small groups.  Here the rows are first
counted per (group, value) with an ordinary partial aggregate (a hot group
collapses to its distinct values before any shuffle), a window over the few
distinct values of each group turns counts into cumulative positions, and
the middle value(s) are picked with a fixed-width hash aggregate.  Result:
the same number MEDIAN gives (average of the two middle values for an even
count, NULL when a group has no non-NULL value), plus count and mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def median_count_mean(
    rows: DataFrame,
    keys: list[str],
    value: str,
    median_col: str,
    mean_col: str,
    count_col: str,
) -> DataFrame:
    """Per group: COUNT(*) as ``count_col``, AVG(value) and exact MEDIAN(value)."""
    v = F.col(value)
    hist = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_h_c"))
    known = F.when(v.isNotNull(), F.col("_h_c"))
    ordered = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, 0)
    # same order, so that both sums come from one pass over a group
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hist = hist.withColumns({"_h_cum": F.sum(known).over(ordered), "_h_n": F.sum(known).over(whole)})
    lo = F.floor((F.col("_h_n") + 1) / 2)
    hi = F.floor(F.col("_h_n") / 2) + 1
    before = F.col("_h_cum") - F.col("_h_c")

    def value_at(pos):
        return F.max(F.when(v.isNotNull() & (before < pos) & (pos <= F.col("_h_cum")), v))

    return hist.groupBy(*keys).agg(
        F.sum("_h_c").alias(count_col),
        (F.sum(v * F.col("_h_c")) / F.sum(known)).alias(mean_col),
        ((value_at(lo) + value_at(hi)) / 2.0).alias(median_col),
    )
