"""Best offset per trip without scoring every offset: exact bounds over blocks of offsets.

A trip with R observed rows and W = static_count - rt_count + 1 offsets has R x W candidate rows.
Here the offsets of a trip are cut into blocks of ``width`` (half the root of W, as some four blocks survive).  The stops an
observed row can meet inside a block lie in two neighbouring cells of ``width`` timetable
positions, so the earliest and latest scheduled second of the two cells bound the row's absolute
minute error from below and above for every offset of the block at once.  The median of the lower
bounds bounds the median error of each offset of the block from below, the median of the upper
bounds from above (medians are monotone).  A block whose lower median exceeds the smallest upper
median of its trip holds no winner; the offsets of the other blocks are scored exactly.

Bounds cost R x W / width rows and a survivor R x width, instead of R x W.  No order of the
timetable is assumed.  Rows without an arrival count in no median, so they are left out; a cell
with a stop without a time makes the lower bound 0 (an extra 0 never raises a median) and forbids
the upper one.  A trip without any arrival has only NULL scores: offset 0 wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.constants import DEFAULT_TZ
from headway.functions.timefn import hms_seconds, local_epoch_seconds, minute_diff_seconds
from headway.operators.median import median_count_mean
from headway.operators.sizing import conf_int, remembered

#: Trips with up to so many offsets are scored whole: bounds would cost as much as they save.
WHOLE_OFFSETS = 32


def whole_offsets(spark) -> int:
    return conf_int(spark, "headway.align.wholeOffsets", WHOLE_OFFSETS)


def whole_ranges(candidates: DataFrame) -> DataFrame:
    """All offsets of every candidate trip as one range."""
    last = (F.col("static_count") - F.col("rt_count")).cast("int")
    return candidates.select("trip_id", F.lit(0).alias("first_offset"), last.alias("last_offset"))


def offset_ranges(
    rt_seq: DataFrame,
    st_seq: DataFrame,
    candidates: DataFrame,
    tz: str = DEFAULT_TZ,
    whole: int | None = None,
) -> DataFrame:
    """(trip_id, first_offset, last_offset): ranges that hold the best offset of every candidate trip.

    The ranges of a trip do not overlap.  Trips of at most ``whole`` offsets have one range; whether
    there are longer ones is checked once per plan, over the counts alone.
    """
    whole = whole_offsets(candidates.sparkSession) if whole is None else whole
    sized = candidates.withColumn("_last", (F.col("static_count") - F.col("rt_count")).cast("int"))
    long = sized.where(F.col("_last") >= whole)
    if not remembered(candidates, f"offsets>{whole}", lambda: long.take(1)):
        return whole_ranges(candidates)
    short = whole_ranges(sized.where(F.col("_last") < whole))
    return short.unionByName(_surviving_blocks(rt_seq, st_seq, long.select("trip_id", "_last"), tz))


def block_bounds(rt_seq: DataFrame, st_seq: DataFrame, long: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Per (trip, block) bounds of the median absolute minute error over the block's offsets.

    ``long``: trip_id and _last (its last offset).  Columns: trip_id, width, block, lower, upper
    (NULL where the block meets stops without a time).  Trips without any arrival have no rows.
    """
    trips = long.select("trip_id", "_last", F.ceil(F.sqrt(F.col("_last") + 1) / 2).cast("int").alias("width"))
    # The two cells a row meets start where its first offset falls, so a cell's figures are
    # entered for itself and for the cell before it, and added up there.
    second = hms_seconds("arrival_time")
    stops = st_seq.join(trips.select("trip_id", "width"), "trip_id").select(
        "trip_id", F.floor(F.col("static_seq") / F.col("width")).cast("int").alias("_own"), second.alias("_s")
    )
    cells = stops.groupBy("trip_id", "_own").agg(
        F.min("_s").alias("_lo"), F.max("_s").alias("_hi"), F.max(F.col("_s").isNull()).alias("_open")
    )
    cells = cells.select("*", F.explode(F.array(F.col("_own") - 1, F.col("_own"))).alias("cell"))
    cells = cells.groupBy("trip_id", "cell").agg(
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_open").alias("_open")
    )
    rows = rt_seq.where(F.col("arrival_time_unix").isNotNull()).join(trips, "trip_id").select(
        "trip_id", "width", "rt_seq", local_epoch_seconds("arrival_time_unix", tz).alias("_actual"),
        F.explode(F.sequence(F.lit(0), F.floor(F.col("_last") / F.col("width")).cast("int"))).alias("block"),
    )
    first = F.col("rt_seq") + F.col("block") * F.col("width")
    rows = rows.withColumn("cell", F.floor(first / F.col("width")).cast("int")).join(cells, ["trip_id", "cell"])

    def diff(edge: str):
        midnight = F.col("_actual") - F.pmod(F.col("_actual"), F.lit(86400))
        return minute_diff_seconds(midnight + F.col(edge), F.col("_actual"))

    after_first, after_last = diff("_lo"), diff("_hi")
    lower = F.when(F.col("_open"), F.lit(0)).otherwise(F.greatest(-after_first, after_last, F.lit(0)))
    upper = F.greatest(F.abs(after_first), F.abs(after_last))
    rows = rows.select(
        "trip_id", "width", "block", "_open",
        F.explode(F.array(F.struct(F.lit(False).alias("above"), lower.alias("v")), F.struct(F.lit(True).alias("above"), upper.alias("v")))).alias("b"),
    ).select("trip_id", "width", "block", F.col("b.above").alias("above"), F.when(F.col("above") & F.col("_open"), None).otherwise(F.col("b.v")).alias("v"))
    # An open row has no upper bound; counting rows against known values shows that.
    sides = median_count_mean(
        rows.withColumn("known", F.col("v").isNotNull()).select("trip_id", "width", "block", "above", "known", "v"),
        ["trip_id", "width", "block", "above", "known"], "v", "bound", "_mean", "_n",
    )
    return sides.groupBy("trip_id", "width", "block").agg(
        F.max(F.when(~F.col("above"), F.col("bound"))).alias("lower"),
        F.when(F.max(F.col("above") & ~F.col("known")), None).otherwise(F.max(F.when(F.col("above"), F.col("bound")))).alias("upper"),
    )


def _surviving_blocks(rt_seq: DataFrame, st_seq: DataFrame, long: DataFrame, tz: str) -> DataFrame:
    bounds = block_bounds(rt_seq, st_seq, long, tz)
    least = bounds.groupBy("trip_id").agg(F.min("upper").alias("_least"))
    kept = bounds.join(least, "trip_id").where(F.col("_least").isNull() | (F.col("lower") <= F.col("_least")))
    first = F.col("block") * F.col("width")
    ranges = long.join(kept.select("trip_id", "width", "block"), "trip_id", "left").select(
        "trip_id",
        F.coalesce(first, F.lit(0)).cast("int").alias("first_offset"),
        # no block: no arrival at all, offset 0 wins with a NULL score
        F.when(first.isNull(), F.lit(0)).otherwise(F.least(first + F.col("width") - 1, F.col("_last"))).cast("int").alias("last_offset"),
    )
    return ranges
