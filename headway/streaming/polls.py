"""Structured Streaming: continuous poll append (S1) and refresh of delay layer and marts.

S1 reads feed documents as they land in a folder, flattens them and appends
the rows to the poll log.  S2 does the same inside ``foreachBatch`` and then
recomputes the delay layer for the trips a batch touched: the best offset of
a trip depends on all of its rows, so it is recomputed rather than updated
from state.  Poll log, timetable and delay layer are all stored by
``trip_bucket``, so a batch reads and rewrites the touched buckets only.  A
touched bucket that comes back without rows is removed, as its trips no longer
align.  A replayed batch does the same again, so the sink stays exactly-once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway import schemas
from headway.operators import kpi
from headway.operators.align import align_best_offset
from headway.operators.delay import delay_layer
from headway.session import checkpoint_dir
from headway.sources.observed import StreamSummary
from headway.sources.realtime import RT_COLUMNS, flatten_trip_updates
from headway.sources.tables import write_table
from headway.streaming.versions import remove_folder, write_sliced

DEFAULT_TRIP_BUCKETS = 256


def trip_bucket(col: str = "trip_id", buckets: int = DEFAULT_TRIP_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def poll_stream(spark: SparkSession, feed_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of flattened rows from JSON feed documents in ``feed_dir``."""
    reader = spark.readStream.schema(schemas.FEED_DOCUMENT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten_trip_updates(reader.json(feed_dir))


def start_poll_append(
    spark: SparkSession,
    feed_dir: str,
    sink_dir: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    processing_time: str = "30 seconds",
    summary: StreamSummary | None = None,
) -> StreamingQuery:
    """Append flattened polls to a parquet poll log (checkpointed, exactly once).

    ``summary``, added to the session's listeners by the caller, gets the figures of the rows of each batch.
    """
    rows = poll_stream(spark, feed_dir, max_files_per_trigger)
    if summary is not None:
        rows = summary.observed(rows)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def write_by_bucket(df: DataFrame, path: str, buckets: int, overwrite: str = "static") -> list[int]:
    """Store rows of a trip-keyed table by trip bucket; a bucket of many rows is written by several tasks."""
    return write_sliced(df.withColumn("trip_bucket", trip_bucket(buckets=buckets)), path, "trip_bucket", overwrite=overwrite)


def refresh_touched_trips(
    touched_rows: DataFrame,
    poll_log: DataFrame,
    stop_times: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    out_dir: str,
    buckets: int = DEFAULT_TRIP_BUCKETS,
    snapshot: str | None = None,
) -> None:
    """Recompute the delay layer of every trip bucket touched by ``touched_rows``.

    ``poll_log`` and ``stop_times`` carry trip_bucket as their partition column.
    """
    spark = touched_rows.sparkSession
    rows = touched_rows.select(trip_bucket(buckets=buckets).alias("trip_bucket")).where("trip_bucket is not null").distinct()
    touched = [r["trip_bucket"] for r in rows.collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    own = F.col("trip_bucket").isin(touched)
    rt, st = poll_log.where(own).drop("trip_bucket"), stop_times.where(own).drop("trip_bucket")
    delay = delay_layer(align_best_offset(rt, st, trips, stops, snapshot=snapshot))
    pending = f"{out_dir.rstrip('/')}-pending"
    delay.write.mode("overwrite").parquet(pending)  # the alignment runs once, whatever is counted and read from its rows
    fresh = spark.read.schema(delay.schema).parquet(pending)
    filled = set(write_by_bucket(fresh, out_dir, buckets, overwrite="dynamic"))
    for bucket in set(touched) - filled:
        remove_folder(spark, f"{out_dir.rstrip('/')}/trip_bucket={bucket}")
    remove_folder(spark, pending)


def refresh_marts(delay: DataFrame, rt_updates: DataFrame, trips: DataFrame, out_dir: str) -> None:
    """Rewrite the route, stop and route-hour marts from the delay layer as it stands."""
    write_table(kpi.route_performance(delay, rt_updates, trips), f"{out_dir}/route_performance")
    routes = delay.sparkSession.read.parquet(f"{out_dir}/route_performance")
    write_table(kpi.stop_performance(delay, routes), f"{out_dir}/stop_performance")
    write_table(kpi.route_hour_performance(delay, rt_updates, trips), f"{out_dir}/route_hour_performance")


def start_delay_refresh(
    spark: SparkSession,
    feed_dir: str,
    poll_log_dir: str,
    delay_dir: str,
    checkpoint_location: str,
    stop_times: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    buckets: int = DEFAULT_TRIP_BUCKETS,
    snapshot: str | None = None,
    marts_dir: str | None = None,
) -> StreamingQuery:
    """S1 + S2: log each batch (idempotently, one folder per batch id), refresh touched trips, then the marts.

    ``marts_dir``: where the marts are rewritten after each batch; they are left alone without it.
    """
    timetable_dir = f"{poll_log_dir.rstrip('/')}-timetable"
    write_by_bucket(stop_times, timetable_dir, buckets)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch = batch.select(*RT_COLUMNS)
        write_by_bucket(batch, f"{poll_log_dir.rstrip('/')}/batch_id={batch_id}", buckets)
        logged = T.StructType([*batch.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("trip_bucket", T.IntegerType())])
        poll_log = session.read.schema(logged).parquet(poll_log_dir).select(*RT_COLUMNS, "trip_bucket")
        timetable = session.read.parquet(timetable_dir)
        refresh_touched_trips(batch, poll_log, timetable, trips, stops, delay_dir, buckets, snapshot)
        if marts_dir:
            refresh_marts(session.read.parquet(delay_dir), poll_log, trips, marts_dir)

    writer = poll_stream(spark, feed_dir, max_files_per_trigger).writeStream.foreachBatch(on_batch).option(
        "checkpointLocation", checkpoint_location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
