"""Checks from the write itself: figures gathered while a table or a stream's batch is written, without another scan.

Figures are aggregates that ``DataFrame.observe`` computes as the rows pass to the sink, so they describe
exactly what a finished write has written.  A write that fails gives none.
"""

from __future__ import annotations

import threading
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from headway.functions.numeric import count_when
from headway.sources.tables import write_table

LOADS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("row_count", T.LongType()), T.StructField("min_ts", T.StringType()), T.StructField("max_ts", T.StringType())])
RECONCILED = T.StructType([
    T.StructField("mart_name", T.StringType()), T.StructField("total_events", T.LongType()), T.StructField("delay_rows", T.LongType()), T.StructField("reconciled", T.BooleanType()),
])
NULLS = T.StructType([T.StructField(c, T.LongType()) for c in ("null_route_id", "null_avg_delay", "null_on_time_rate")])


def rows_written() -> dict[str, Column]:
    return {"row_count": F.count(F.lit(1))}


def time_span(col: str | None) -> dict[str, Column]:
    """Row count and least and greatest value of a time column (as text)."""
    c = F.col(col).cast("string") if col else F.lit(None).cast("string")
    return {**rows_written(), "min_ts": F.min(c), "max_ts": F.max(c)}


def event_totals() -> dict[str, Column]:
    """A mart's rows and the stop events that they sum up."""
    return {**rows_written(), "total_events": F.sum("stop_event_count").cast("bigint")}


def null_counts() -> dict[str, Column]:
    """Null audit of the route mart."""
    of = {"null_route_id": "route_id", "null_avg_delay": "avg_delay_minutes", "null_on_time_rate": "on_time_rate"}
    return {name: count_when(F.col(c).isNull()) for name, c in of.items()}


def write_observed(df: DataFrame, name_or_path: str, figures: dict[str, Column], partition_by: list[str] | None = None) -> dict[str, Any]:
    """Full refresh of a table, and the figures of the rows that it now holds."""
    seen = Observation(f"write-{uuid.uuid4().hex}")
    observed = df.observe(seen, *(c.alias(name) for name, c in figures.items()))
    write_table(observed, name_or_path, partition_by)
    return seen.get


def load_tables(spark: SparkSession, tables: dict[str, tuple[DataFrame, str | None]], base: str) -> DataFrame:
    """Write each table under ``base``; the load summary of what was written, a row per table."""
    rows = []
    for name, (df, col) in tables.items():
        got = write_observed(df, f"{base.rstrip('/')}/{name}", time_span(col))
        rows.append((name, got["row_count"], got["min_ts"], got["max_ts"]))
    return spark.createDataFrame(rows, LOADS)


def reconciliation(spark: SparkSession, delay_rows: int, marts: dict[str, dict[str, Any]]) -> DataFrame:
    """Each mart's stop events, as its write observed them, against the rows of the delay layer."""
    rows = [(name, got["total_events"], delay_rows, None if got["total_events"] is None else got["total_events"] == delay_rows) for name, got in marts.items()]
    return spark.createDataFrame(rows, RECONCILED)


def null_audit(spark: SparkSession, got: dict[str, Any]) -> DataFrame:
    return spark.createDataFrame([tuple(got[c] for c in NULLS.names)], NULLS)


class StreamSummary(StreamingQueryListener):
    """Load summary of a stream's runs, added up from the figures of each finished batch.

    The stream's frame is observed under ``name`` (``observed``).  A batch counts once, by its number; what is
    kept is one row, whatever the length of the stream.  Progress lives with the driver: a summary covers the
    batches that end while it listens, not those of runs before it.
    """

    def __init__(self, name: str, col: str | None):
        self.name, self.col = name, col
        self.count, self.least, self.greatest, self.last = 0, None, None, -1
        self.ended = threading.Event()

    def observed(self, stream: DataFrame) -> DataFrame:
        return stream.observe(self.name, *(c.alias(n) for n, c in time_span(self.col).items()))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        got = event.progress.observedMetrics.get(self.name)
        if got is not None and event.progress.batchId > self.last:
            self.add(got)
            self.last = event.progress.batchId

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def add(self, got) -> None:
        known = lambda values: [v for v in values if v is not None]
        self.count += got["row_count"]
        self.least = min(known([self.least, got["min_ts"]]), default=None)
        self.greatest = max(known([self.greatest, got["max_ts"]]), default=None)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.name, self.count, self.least, self.greatest)], LOADS)
