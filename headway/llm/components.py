"""Connected components of an edge table, by contraction rounds on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node and component_id (the smallest node reachable) for every node of ``edges`` (a, b).

    Each round, a node points to the smallest of itself and its neighbours, and edges are redrawn
    between what their ends point to.  Node numbers are replaced by hashes first, so paths in
    ascending order, too, shrink by a share of their length each round.  Minima are pre-aggregated
    before the shuffle; nothing of a component is collected in one place.  Nulls have no links.
    """
    known = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    named = known.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.xxhash64("node"))
    live = staged(known.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")).where("a != b").distinct())
    parents: list[DataFrame] = []
    while not live.isEmpty():
        both = live.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        parent = both.groupBy(F.col("e.a").alias("label")).agg(F.min("e.b").alias("least"))
        parents.append(staged(parent.select("label", F.least("least", "label").alias("parent"))))
        first = live.join(parents[-1].withColumnsRenamed({"label": "a", "parent": "x"}), "a")
        second = first.join(parents[-1].withColumnsRenamed({"label": "b", "parent": "y"}), "b").where("x != y")
        live = staged(second.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    # what a label points to in the end, from the last round back to the first
    final = None
    for parent in reversed(parents):
        if final is not None:
            later = final.select(F.col("label").alias("parent"), F.col("parent").alias("last"))
            parent = parent.join(later, "parent", "left").select("label", F.coalesce("last", "parent").alias("parent"))
        final = parent
    if final is not None:
        named = named.join(final, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
    named = staged(named)
    smallest = named.groupBy("label").agg(F.min("node").alias("component_id"))
    return named.join(smallest, "label").select("node", "component_id")
