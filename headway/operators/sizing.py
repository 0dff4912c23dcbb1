"""Skew settings read from the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Keys with more rows than this are sequenced by the split (hot-key) path.
DEFAULT_HOT_KEY_ROWS = 2_000_000

def conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value else default


def hot_key_rows(spark: SparkSession) -> int:
    return conf_int(spark, "headway.skew.hotKeyRows", DEFAULT_HOT_KEY_ROWS)


_DECISIONS: dict[tuple, bool] = {}


def remembered(df: DataFrame, tag: str, check) -> bool:
    """Run a plan-level check once per (session, plan, tag).

    Used only for physical-path choices (split hot keys or not); both outcomes give the same result, so a remembered answer can make
    a later run slower but never wrong.
    """
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tag)
    if key not in _DECISIONS:
        _DECISIONS[key] = bool(check())
    return _DECISIONS[key]
