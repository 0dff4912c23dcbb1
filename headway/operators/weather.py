"""Weather enrichment (hour bucket join) and weather impact tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import constants as K
from headway.functions.labels import is_raining, on_time, precipitation_bucket
from headway.functions.numeric import count_when, pct, round_half
from headway.functions.timefn import parse_local_hour, trunc_hour
from headway.operators.histogram import delay_kpis
from headway.operators.kpi import n_rows


def weather_by_hour(weather: DataFrame) -> DataFrame:
    """Raw hourly rows -> (weather_local_hour, precipitation, temperature, wind)."""
    return weather.select(
        parse_local_hour(F.col("observation_datetime")).alias("weather_local_hour"),
        "precipitation_mm",
        "temperature_c",
        "windspeed_kmh",
    )


def enrich_weather(delay: DataFrame, weather: DataFrame, dedupe_hours: bool = False) -> DataFrame:
    """Left join delay rows to hourly weather on the local arrival hour.

    Weather has one row per observed hour, a table that grows with the time
    span only; Spark broadcasts it where it is small enough by its own size
    estimate and else joins by the hour.  Duplicate weather hours fan out rows, as published, unless
    ``dedupe_hours`` keeps one row per hour.
    """
    w = weather_by_hour(weather)
    if dedupe_hours:
        w = w.dropDuplicates(["weather_local_hour"])
    d = delay.withColumn("actual_arrival_local_hour", trunc_hour(F.col("actual_arrival_local_ts")))
    joined = d.join(w, d["actual_arrival_local_hour"] == w["weather_local_hour"], "left")
    p = F.col("precipitation_mm")
    return joined.select(
        *[d[c] for c in d.columns],
        p,
        is_raining(p).alias("is_raining"),
        precipitation_bucket(p).alias("precipitation_bucket"),
        "temperature_c",
        "windspeed_kmh",
    )


def weather_impact(enriched: DataFrame) -> DataFrame:
    keys = ["precipitation_bucket", "is_raining"]
    return delay_kpis(enriched, keys).select(
        *keys, "stop_event_count", "trip_count", "avg_delay_minutes", "median_delay_minutes", "p95_delay_minutes", "on_time_rate"
    )


def route_weather_impact(enriched: DataFrame) -> DataFrame:
    keys = ["route_id", "precipitation_bucket", "is_raining"]
    means = enriched.groupBy(*keys).agg(
        round_half(F.avg("temperature_c"), 2).alias("avg_temperature_c"),
        round_half(F.avg("windspeed_kmh"), 2).alias("avg_windspeed_kmh"),
    )
    kpis = delay_kpis(enriched, keys).alias("k")
    same = reduce(lambda a, b: a & b, (F.col(f"k.{c}").eqNullSafe(F.col(f"m.{c}")) for c in keys))
    return kpis.join(means.alias("m"), same).select(
        *(F.col(f"k.{c}") for c in keys), "stop_event_count", "trip_count", "avg_delay_minutes", "median_delay_minutes",
        "on_time_rate", "avg_temperature_c", "avg_windspeed_kmh",
    )


def weather_join_quality(enriched: DataFrame) -> DataFrame:
    known = F.col("precipitation_bucket") != K.PRECIP_UNKNOWN
    unknown = F.col("precipitation_bucket") == K.PRECIP_UNKNOWN
    return enriched.agg(
        n_rows().alias("total_rows"),
        count_when(known).alias("weather_matched_rows"),
        count_when(unknown).alias("weather_unknown_rows"),
        pct(count_when(known), n_rows()).alias("weather_match_rate"),
        count_when(F.col("is_raining")).alias("rainy_rows"),
        round_half(F.avg("delay_minutes"), 2).alias("avg_delay_minutes"),
        round_half(F.median("delay_minutes"), 2).alias("median_delay_minutes"),
    )


def _weather_type():
    return F.when(F.col("is_raining"), F.lit("rainy")).otherwise(F.lit("dry"))


def dry_vs_rainy(enriched: DataFrame) -> DataFrame:
    """Rows with known weather split into dry and rainy."""
    known = enriched.where(F.col("precipitation_bucket") != K.PRECIP_UNKNOWN)
    return known.groupBy(_weather_type().alias("weather_type")).agg(
        n_rows().alias("rows"),
        round_half(F.avg("delay_minutes"), 2).alias("avg_delay"),
        pct(count_when(on_time(F.col("delay_minutes"))), n_rows()).alias("on_time_rate"),
    )


def rain_sensitivity_rows(enriched: DataFrame, k: int = 10) -> DataFrame:
    """Top-k routes by rainy minus dry mean delay (row weighted, unknown excluded).

    Routes need both dry and rainy rows.  Pivot on the weather type with the
    two values spelled out, so no extra pass collects the pivot values.
    """
    known = enriched.where(F.col("precipitation_bucket") != K.PRECIP_UNKNOWN)
    piv = (
        known.withColumn("weather_type", _weather_type())
        .groupBy("route_id")
        .pivot("weather_type", ["dry", "rainy"])
        .agg(n_rows().alias("rows"), F.avg("delay_minutes").alias("avg"))
    )
    out = piv.select(
        "route_id",
        F.coalesce("dry_rows", F.lit(0).cast("bigint")).alias("dry_rows"),
        F.coalesce("rainy_rows", F.lit(0).cast("bigint")).alias("rainy_rows"),
        round_half(F.col("dry_avg"), 2).alias("dry_avg_delay"),
        round_half(F.col("rainy_avg"), 2).alias("rainy_avg_delay"),
        round_half(F.col("rainy_avg") - F.col("dry_avg"), 2).alias("rainy_minus_dry_delay"),
    ).where((F.col("dry_rows") > 0) & (F.col("rainy_rows") > 0))
    return out.orderBy(F.desc("rainy_minus_dry_delay"), F.asc("route_id")).limit(k)


def rain_sensitivity_buckets(route_weather: DataFrame) -> DataFrame:
    """Dashboard form: mean of bucket means per (route, raining), unknown counted as dry."""
    piv = route_weather.groupBy("route_id").pivot("is_raining", [False, True]).agg(F.avg("avg_delay_minutes"))
    piv = piv.where(F.col("false").isNotNull() & F.col("true").isNotNull())
    # Means of already rounded means: 4 decimals keep the result independent
    # of summation order.
    return piv.select(
        "route_id",
        round_half(F.col("false"), 4).alias("dry_avg"),
        round_half(F.col("true"), 4).alias("rainy_avg"),
        round_half(F.col("true") - F.col("false"), 4).alias("delta"),
    )
