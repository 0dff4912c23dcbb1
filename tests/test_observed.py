"""Figures from the write itself equal a scan of what was written; nothing is scanned for them again."""

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators import audits as AU
from headway.sources import observed as OB
from headway.streaming.polls import scratch_folder, start_poll_append
from tests.test_stream_marts import BATCHES, feed, rows_of


def test_a_write_observes_what_it_writes(spark):
    base = scratch_folder(spark, "observed")
    rows = spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id"))).alias("ts"))
    shuffled = rows.repartition(5).groupBy("ts").agg(F.count(F.lit(1)).alias("n"))
    tables = {"plain": (rows, "ts"), "grouped": (shuffled, "ts"), "untimed": (rows, None), "empty": (rows.where("id < 0"), "ts"), "nothing": (spark.createDataFrame([], "ts string"), "ts")}
    found = OB.load_tables(spark, tables, base)
    read = {name: (spark.read.parquet(f"{base}/{name}"), col) for name, (_, col) in tables.items()}
    assert rows_of(found) == rows_of(AU.load_summary(read))
    assert "FileScan" not in found._jdf.queryExecution().toString()


def test_a_failing_write_gives_no_figures(spark):
    bad = spark.range(10).select(F.raise_error(F.lit("no")).cast("string").alias("ts"))
    with pytest.raises(Exception, match="no"):
        OB.write_observed(bad, f"{scratch_folder(spark, 'failing')}/t", OB.time_span("ts"))


def test_reconciliation_names_the_mart_that_differs(spark):
    marts = {"good": {"total_events": 5}, "bad": {"total_events": 4}, "empty": {"total_events": None}}
    assert rows_of(OB.reconciliation(spark, 5, marts)) == rows_of(spark.createDataFrame([("good", 5, 5, True), ("bad", 4, 5, False), ("empty", None, 5, None)], OB.RECONCILED))


def test_a_stream_is_summed_up_over_batches_and_restarts(spark):
    base = scratch_folder(spark, "summed")
    summary, seen = OB.StreamSummary("polls", "poll_timestamp"), []
    spark.streams.addListener(summary)
    try:
        for rows in BATCHES:
            seen += rows
            feed(spark, rows, f"{base}/feed")
            summary.ended.clear()
            start_poll_append(spark, f"{base}/feed", f"{base}/polls", f"{base}/c", max_files_per_trigger=2, summary=summary).awaitTermination()
            assert summary.ended.wait(60)
    finally:
        spark.streams.removeListener(summary)
    assert rows_of(summary.frame(spark)) == [tuple(sorted({"table_name": "polls", "row_count": len(seen), "min_ts": "p1", "max_ts": "p3"}.items()))]
    assert spark.read.parquet(f"{base}/polls").count() == len(seen)
    assert spark.createDataFrame(seen, schemas.RT_TRIP_UPDATES).count() == summary.count
