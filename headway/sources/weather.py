"""Hourly weather documents (parallel arrays) -> rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.functions.timefn import parse_local_time

WEATHER_COLUMNS = [f.name for f in schemas.WEATHER_HOURLY.fields]


def flatten_hourly_weather(docs: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Zip the four hourly arrays into rows; a document without ``hourly`` is an error."""
    # A filter (unlike a projected column) cannot be pruned away, so the
    # check always runs.
    checked = docs.where(
        F.when(F.col("hourly").isNull(), F.raise_error(F.lit("No hourly weather data returned"))).otherwise(F.lit(True))
    )
    rows = checked.select(
        "latitude",
        "longitude",
        F.inline(
            F.arrays_zip(
                F.col("hourly.time").alias("observation_datetime"),
                F.col("hourly.precipitation").alias("precipitation_mm"),
                F.col("hourly.temperature_2m").alias("temperature_c"),
                F.col("hourly.windspeed_10m").alias("windspeed_kmh"),
            )
        ),
    )
    return rows.select(
        "observation_datetime",
        "precipitation_mm",
        "temperature_c",
        "windspeed_kmh",
        "latitude",
        "longitude",
        F.lit(loaded_at).cast("string").alias("loaded_at"),
    )


def restrict_days(weather: DataFrame, as_of: str | dt.date, days_back: int = 7) -> DataFrame:
    """Keep observations dated from ``as_of - days_back`` to ``as_of`` inclusive."""
    d = F.to_date(parse_local_time(F.col("observation_datetime")))
    end = F.lit(str(as_of)).cast("date")
    return weather.where(d.between(F.date_sub(end, days_back), end))


def build_weather_documents(weather: DataFrame) -> DataFrame:
    """One document per local day with the hourly parallel arrays (inverse of flatten)."""
    day = F.substring("observation_datetime", 1, 10)
    obs = F.struct("observation_datetime", "precipitation_mm", "temperature_c", "windspeed_kmh")
    g = weather.groupBy(day.alias("day"), "latitude", "longitude").agg(F.array_sort(F.collect_list(obs)).alias("obs"))
    return g.select(
        "latitude",
        "longitude",
        F.struct(
            F.transform("obs", lambda o: o["observation_datetime"]).alias("time"),
            F.transform("obs", lambda o: o["precipitation_mm"]).alias("precipitation"),
            F.transform("obs", lambda o: o["temperature_c"]).alias("temperature_2m"),
            F.transform("obs", lambda o: o["windspeed_kmh"]).alias("windspeed_10m"),
        ).alias("hourly"),
    )


def read_weather_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WEATHER_DOCUMENT).json(path)
