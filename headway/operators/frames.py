"""Small frame utilities that avoid cross joins and driver round trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Put single-row aggregates next to each other in one row.

    The frames (each one row, disjoint column names) are unioned with missing
    columns as NULL and folded with MAX, so no join or cross product is built.
    """
    cols: list[str] = []
    for df in single_rows:
        cols.extend(c for c in df.columns if c not in cols)
    unioned = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single_rows)
    return unioned.agg(*[F.max(c).alias(c) for c in cols])

