"""Skew-aware ROW_NUMBER: the split (hot-key) path equals the plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.operators.sequence import sequence_number


def _frame(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else f"k{rnd.randint(0, 40)}"
        if i % 97 == 0:
            key = None
        ts = rnd.choice([None] + list(range(50)))
        rows.append((key, ts, f"s{i}"))
    return spark.createDataFrame(rows, "k string, ts long, tie string")


def test_split_path_matches_window(spark):
    df = _frame(spark)
    order = [F.asc_nulls_last("ts"), F.asc_nulls_last("tie")]
    split = sequence_number(df, "k", order, "rn", "n", hot_rows=100, force_split=True)
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("k"))
    )
    def key(row):
        return tuple((v is None, str(v)) for v in row)

    a = sorted((tuple(r) for r in split.collect()), key=key)
    b = sorted((tuple(r) for r in plain.collect()), key=key)
    assert a == b


def test_check_path_without_hot_keys(spark):
    df = _frame(spark)
    order = [F.asc_nulls_last("ts"), F.asc_nulls_last("tie")]
    out = sequence_number(df, "k", order, "rn", "n", hot_rows=10_000)
    assert "Window" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == df.count()
    per_key = out.groupBy("k").agg(F.max("rn").alias("m"), F.max("n").alias("n")).collect()
    assert all(r.m == r.n for r in per_key)


def test_forced_split_inside_alignment_matches_plain(spark):
    """Many trips on the split path must give the same best offsets as the plain path."""
    from headway.operators import align as A
    from headway.sources.fixtures import load_transit

    t = load_transit(spark, "/root/testdata/sf0.001")

    def best():
        rs, ss = A.rt_sequence(t.rt_updates), A.static_sequence(t.stop_times)
        cand = A.offset_candidates(t.rt_updates, t.stop_times, t.trips)
        return sorted(tuple(r) for r in A.best_offsets(A.score_offsets(rs, ss, cand)).collect())

    plain = best()
    spark.conf.set("headway.skew.hotKeyRows", "3")
    try:
        split = best()
    finally:
        spark.conf.unset("headway.skew.hotKeyRows")
    assert split == plain and len(plain) > 0
