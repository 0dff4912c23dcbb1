"""Static timetable files: CSV folders and zip archives of CSV members."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas
from headway.sources.archives import read_members

# Timetable members and the table each one loads into.
STATIC_MEMBERS = {
    "stops.txt": ("gtfs_stops", schemas.STOPS),
    "routes.txt": ("gtfs_routes", schemas.ROUTES),
    "trips.txt": ("gtfs_trips", schemas.TRIPS),
    "stop_times.txt": ("gtfs_stop_times", schemas.STOP_TIMES),
}


def _with_loaded_at(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", F.current_timestamp())


def _read_member_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV read as strings, then cast to the target schema by column name.

    Columns absent from the file become NULL; extra columns are ignored.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    have = set(raw.columns)
    return raw.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_static(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Load the four timetable members of a folder; a missing member is an error."""
    out = {}
    for member, (table, schema) in STATIC_MEMBERS.items():
        path = os.path.join(folder, member)
        if not _exists(spark, path):
            raise FileNotFoundError(f"{member} not found in {folder}")
        out[table] = _with_loaded_at(_read_member_csv(spark, path, schema))
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_static_archives(spark: SparkSession, pattern: str) -> dict[str, DataFrame]:
    """Load timetable members from many zip archives (one feed per archive).

    Each (archive, member) is a partition of its own, read by ranges and streamed (``archives``).
    Fields go by the header's names: a column that a member lacks is NULL, further ones are ignored,
    an empty field is NULL.  A member missing from an archive is an error, as for a folder.
    """
    out = {}
    for member, rows in read_members(spark, pattern, list(STATIC_MEMBERS)).items():
        table, schema = STATIC_MEMBERS[member]
        place = lambda name: F.array_position("names", name).cast("int")
        value = lambda name: F.when(place(name) > 0, F.nullif(F.get("fields", place(name) - 1), F.lit("")))
        out[table] = _with_loaded_at(rows.select("archive", *(value(f.name).cast(f.dataType).alias(f.name) for f in schema.fields)))
    return out
