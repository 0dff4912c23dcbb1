"""Ordinal position within a group (ROW_NUMBER / COUNT OVER), skew aware.

A plain window sorts every row of a key inside one task.  When a key holds a
large share of the rows (a trip polled for days, say) that task dominates the
job.  Keys above ``headway.skew.hotKeyRows`` rows therefore take a split path:
the hot rows are range-partitioned on (key, order...) so one key spans many
tasks, each task numbers its slice, and a per-(key, slice) table of counts
gives every slice its starting position.  Every hot key is split: there are at
most rows / hotKeyRows of them, and the joins with their list are planned by size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.sizing import hot_key_rows, remembered
from headway.session import checkpoint_dir


def _hot_key(k: str) -> str:
    return f"_hk_key_{k}"


def _null_safe_on(keys: list[str], extra: Column | None = None) -> Column:
    conds = [F.col(k).eqNullSafe(F.col(_hot_key(k))) for k in keys]
    if extra is not None:
        conds.append(extra)
    return reduce(lambda a, b: a & b, conds)


def key_counts(df: DataFrame, keys: list[str], count_col: str) -> DataFrame:
    """Rows per key; partial aggregation makes this safe under skew."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def sequence_number(
    df: DataFrame,
    keys: str | list[str],
    order: list[Column],
    seq_col: str,
    count_col: str | None = None,
    hot_rows: int | None = None,
    force_split: bool | None = None,
) -> DataFrame:
    """Add ``seq_col`` = ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order).

    ``count_col``, when given, receives COUNT(*) OVER (PARTITION BY keys).
    ``order`` should end with enough tie-breakers to make it total; rows that
    tie on every order column are numbered in an arbitrary order, as with
    ROW_NUMBER itself.  ``force_split`` True/False skips the hot-key check
    (tests use it to exercise each path).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark = df.sparkSession
    hot_rows = hot_key_rows(spark) if hot_rows is None else hot_rows
    cols = df.columns

    counts = key_counts(df, keys, "_hk_n")
    hot_list = counts.where(F.col("_hk_n") > hot_rows)

    def plain_window(frame: DataFrame) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        found = {seq_col: F.row_number().over(ordered)}
        if count_col:  # same order, so that one pass over a key gives both
            found[count_col] = F.count(F.lit(1)).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return frame.withColumns(found)

    # Runtime check (one pass over the key column, like a statistics scan):
    # without hot keys the plan is a single window stage.
    if force_split is False or (
        not force_split and not remembered(df, f"hot>{hot_rows}:{keys}", lambda: hot_list.take(1))
    ):
        return plain_window(df)

    hot = hot_list.select(*[F.col(k).alias(_hot_key(k)) for k in keys], "_hk_n")

    # Plain path: every key that is not hot.
    plain = plain_window(df.join(hot, _null_safe_on(keys), "left_anti"))

    # Split path: hot keys only.
    hot_df = df.join(hot, _null_safe_on(keys), "inner").select(*cols, "_hk_n")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        hot_df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
        .sortWithinPartitions(*[F.col(k) for k in keys], *order)
        .withColumn("_hk_pid", F.spark_partition_id())
        .withColumn("_hk_id", F.monotonically_increasing_id())
    )
    # Slice ids and row ids depend on the physical partitioning, and the
    # slice table and the rows are two reads of them.  A reliable checkpoint
    # (shared folder, survives executor loss) makes both reads see the same
    # materialised rows; without it a re-planned or recomputed exchange could
    # place a row in another slice.
    checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    slices = ranged.groupBy(*keys, "_hk_pid").agg(
        F.min("_hk_id").alias("_hk_first"), F.count(F.lit(1)).alias("_hk_cnt")
    )
    before = Window.partitionBy(*keys).orderBy("_hk_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        *[F.col(k).alias(_hot_key(k)) for k in keys],
        F.col("_hk_pid").alias("_hk_slice"),
        "_hk_first",
        F.coalesce(F.sum("_hk_cnt").over(before), F.lit(0)).alias("_hk_before"),
    )
    numbered = ranged.join(
        slices, _null_safe_on(keys, F.col("_hk_pid") == F.col("_hk_slice"))
    ).withColumn(seq_col, (F.col("_hk_id") - F.col("_hk_first") + 1 + F.col("_hk_before")).cast("int"))
    out_cols = [*cols, seq_col]
    if count_col:
        numbered = numbered.withColumn(count_col, F.col("_hk_n"))
        out_cols.append(count_col)
    return plain.select(*out_cols).unionByName(numbered.select(*out_cols))
