"""Bucket and label expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions import constants as K


def precipitation_bucket(p: Column) -> Column:
    """NULL -> unknown, 0 -> dry, (0,1) light, [1,5) moderate, else heavy (negatives too)."""
    return (
        F.when(p.isNull(), F.lit(K.PRECIP_UNKNOWN))
        .when(p == 0, F.lit(K.PRECIP_DRY))
        .when((p > 0) & (p < K.PRECIP_LIGHT_MAX), F.lit(K.PRECIP_LIGHT))
        .when((p >= K.PRECIP_LIGHT_MAX) & (p < K.PRECIP_MODERATE_MAX), F.lit(K.PRECIP_MODERATE))
        .otherwise(F.lit(K.PRECIP_HEAVY))
    )


def is_raining(p: Column) -> Column:
    """Unknown weather counts as not raining."""
    return F.coalesce(p, F.lit(0.0)) > 0


def delay_category(delay: Column) -> Column:
    expr = None
    for upper, label in K.DELAY_CATEGORIES:
        expr = (F.when if expr is None else expr.when)(delay < upper, F.lit(label))
    return expr.otherwise(F.lit(K.DELAY_CATEGORY_ELSE))


def offset_bucket(offset: Column) -> Column:
    zero, low, mid, high = K.OFFSET_BUCKETS
    return (
        F.when(offset == 0, F.lit(zero))
        .when(offset.between(1, 5), F.lit(low))
        .when(offset.between(6, 10), F.lit(mid))
        .otherwise(F.lit(high))
    )


def offset_bucket_rank(bucket: Column) -> Column:
    """Sort key 1..4 of an offset bucket label."""
    expr = None
    for i, label in enumerate(K.OFFSET_BUCKETS[:-1], start=1):
        expr = (F.when if expr is None else expr.when)(bucket == label, F.lit(i))
    return expr.otherwise(F.lit(len(K.OFFSET_BUCKETS)))


def day_name(dow_num: Column) -> Column:
    """Sunday = 0 ... Saturday = 6 -> name."""
    expr = None
    for i, name in enumerate(K.DAY_NAMES):
        expr = (F.when if expr is None else expr.when)(dow_num == i, F.lit(name))
    return expr


def on_time(delay: Column) -> Column:
    return delay <= K.ON_TIME_MAX_MINUTES


def delayed(delay: Column) -> Column:
    return delay > K.ON_TIME_MAX_MINUTES


def rain_step(p: Column) -> Column:
    (heavy_mm, heavy_add), (mod_mm, mod_add) = K.RAIN_STEPS
    return (
        F.when(p >= heavy_mm, F.lit(heavy_add))
        .when(p >= mod_mm, F.lit(mod_add))
        .when(p > 0, F.lit(K.RAIN_ANY_STEP))
        .otherwise(F.lit(0.0))
    )


def wind_step(w: Column) -> Column:
    (strong_kmh, strong_add), (fresh_kmh, fresh_add) = K.WIND_STEPS
    return (
        F.when(w >= strong_kmh, F.lit(strong_add))
        .when(w >= fresh_kmh, F.lit(fresh_add))
        .otherwise(F.lit(0.0))
    )


def risk_level(projected: Column) -> Column:
    high, medium, low = K.RISK_LEVELS
    return (
        F.when(projected >= K.RISK_HIGH_MINUTES, F.lit(high))
        .when(projected >= K.RISK_MEDIUM_MINUTES, F.lit(medium))
        .otherwise(F.lit(low))
    )
