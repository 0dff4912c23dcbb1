"""Rounding and percentage helpers (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(x: Column, digits: int) -> Column:
    """Round half away from zero on the scaled value: round(x * 10^n) / 10^n.

    Scaling first makes the result agree with engines that round the binary
    double directly; ``round(x, n)`` on the decimal expansion differs on ties.
    """
    scale = float(10**digits)
    return F.round(x * F.lit(scale), 0) / F.lit(scale)


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole rounded, NULL when whole is 0 (double arithmetic)."""
    return round_half(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def pct_or_zero(part: Column, whole: Column, digits: int = 1) -> Column:
    """Like :func:`pct` but 0.0 instead of NULL when whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        round_half(F.lit(100.0) * part / whole, digits)
    )


def count_when(pred: Column) -> Column:
    """COUNT(CASE WHEN pred THEN 1 END): 0 on empty input."""
    return F.count(F.when(pred, F.lit(1)))


def sum_when(pred: Column) -> Column:
    """SUM(CASE WHEN pred THEN 1 ELSE 0 END): NULL on empty input."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))
