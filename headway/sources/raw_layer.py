"""Persist the raw layer once and read it back bucketed by trip.

Trip-keyed inputs (timetable rows, observed rows, trips) are written as
tables bucketed by ``trip_id`` when no trip is hot (see ``bucketable``).  Reading them back, Spark knows every row of a
trip sits in the same bucket, so the per-trip windows, counts and trip joins
of the alignment run without a shuffle (set
``spark.sql.requireAllClusterKeysForCoPartition=false`` to extend this to the
(trip_id, static_seq) join).  Files go under the shared checkpoint folder;
the tables are registered in the session catalog, so later queries of the
same session reuse them.
"""

from __future__ import annotations

import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from headway.operators.sizing import hot_key_rows
from headway.session import checkpoint_dir
from headway.sources.fixtures import TransitTables, load_transit, order_lines, stop_lines

TRIP_KEYED = ("trips", "stop_times", "rt_updates")
FIELDS = ("trips", "stops", "routes", "stop_times", "rt_updates", "weather", "event_windows", "alert_windows")
MAPPING_VERSION = "v5"
_BUILD_LOCK = threading.RLock()  # one writer per staged table when queries run from several threads


def bucketable(df: DataFrame, key: str) -> bool:
    """True when no key value has more than ``headway.skew.hotKeyRows`` rows.

    Bucketing co-locates a key in one file and one scan task; with a hot key
    that task would read its whole share, so such tables are written plain
    and the skew-aware operators split the hot key after the scan.
    """
    limit = hot_key_rows(df.sparkSession)
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).take(1)


# Per raw-layer database: were all trip-keyed tables bucketed?  Staging tables
# hold at most the observed rows of a trip, so they follow the same decision.
_TRIP_BUCKETED: dict[str, bool] = {}


def _save(df: DataFrame, table: str, path: str, key: str | None, buckets: int, check: bool = True) -> bool:
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    bucket = bool(key) and (not check or bucketable(df, key))
    if bucket:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)
    return bucket


def default_buckets(spark: SparkSession) -> int:
    value = spark.conf.get("headway.raw.buckets", None)
    return int(value) if value else int(spark.conf.get("spark.sql.shuffle.partitions"))


INPUTS = ("orders", "lineitem", "supplier", "events")


def _input_state(spark: SparkSession, sf_dir: str) -> list[str]:
    """Name, size and modification time of every input file, by the file system that holds them."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    state = []
    for name in INPUTS:
        files = path_of(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for status in files.getFileSystem(conf).listStatus(files):
            state.append(f"{status.getPath()}|{status.getLen()}|{status.getModificationTime()}")
    return sorted(state)


def _db_name(spark: SparkSession, sf_dir: str) -> str:
    """A name that changes with the inputs, so tables derived from other data are never reused."""
    digest = hashlib.sha1("\n".join([MAPPING_VERSION, *_input_state(spark, sf_dir)]).encode()).hexdigest()[:10]
    return f"headway_raw_{digest}"


def write_raw_layer(spark: SparkSession, sf_dir: str, db: str, buckets: int) -> None:
    """Derive and write the raw tables; the numbered line items are written first and shared."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/{db}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{base}'")
    lines = f"{base}/stop_lines"
    # one count per trip (by its number) decides on the window and the buckets; numbered by trip id, a bucket is written by one task
    lines_bucketed = bucketable(order_lines(spark, sf_dir), "k")
    _save(stop_lines(spark, sf_dir, hot=not lines_bucketed), f"{db}.stop_lines", lines, "trip_id" if lines_bucketed else None, buckets, check=False)
    tables = load_transit(spark, sf_dir, lines=spark.table(f"{db}.stop_lines"))
    # A trip's timetable and feed rows are subsets of one order's line items and
    # trips hold one row per order, so the line-item check covers every
    # trip-keyed table.
    def save(field: str) -> None:
        key = "trip_id" if field in TRIP_KEYED and lines_bucketed else None
        _save(getattr(tables, field), f"{db}.{field}", f"{base}/{field}", key, buckets, check=False)

    with ThreadPoolExecutor(max_workers=4) as pool:  # independent tables, written at the same time
        list(pool.map(save, FIELDS))
    _TRIP_BUCKETED[db] = lines_bucketed


def raw_transit(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> TransitTables:
    """The transit tables for ``sf_dir`` from the session's raw layer (built on first use)."""
    db = _db_name(spark, sf_dir)
    with _BUILD_LOCK:
        if not all(spark.catalog.tableExists(f"{db}.{f}") for f in FIELDS):
            write_raw_layer(spark, sf_dir, db, buckets or default_buckets(spark))
    co_located = _TRIP_BUCKETED.get(db, False)
    # Tables bucketed by trip also serve joins on (trip_id, position) where they lie.  With a hot
    # trip they are not bucketed, and such joins must spread it over all their keys.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", str(not co_located).lower())
    return TransitTables(*[spark.table(f"{db}.{f}") for f in FIELDS], source_key=db)


def by_trip(t: TransitTables) -> bool:
    """Whether the trip-keyed tables lie by trip, as no trip is hot."""
    return t.source_key is not None and _TRIP_BUCKETED.get(t.source_key, False)


def is_staged(t: TransitTables, name: str) -> bool:
    return t.source_key is not None and t.rt_updates.sparkSession.catalog.tableExists(f"{t.source_key}.{name}")


def staged(t: TransitTables, name: str, build, bucket_by: str | None = "trip_id") -> DataFrame:
    """A staging table derived from persisted inputs, written once per session.

    Mirrors the raw -> staging -> marts layering: the delay layer every mart
    depends on is computed once and read back, instead of being recomputed in
    each consumer of a plan.  Inputs that were not persisted are computed
    in place.
    """
    if t.source_key is None:
        return build()
    spark = t.rt_updates.sparkSession
    table = f"{t.source_key}.{name}"
    with _BUILD_LOCK:
        if not spark.catalog.tableExists(table):
            path = f"{checkpoint_dir(spark).rstrip('/')}/{t.source_key}/{name}"
            key = bucket_by if _TRIP_BUCKETED.get(t.source_key, False) else None
            _save(build(), table, path, key, default_buckets(spark), check=False)
    return spark.table(table)
