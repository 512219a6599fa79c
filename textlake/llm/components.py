"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textlake.llm.files import materialize


def _lowest(pairs: DataFrame, node: str, other: str, name: str) -> DataFrame:
    return materialize(pairs.groupBy(node).agg(F.min(other).alias("low")), name)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of the links (a, b); component is the smallest id reached.

    Large-star and small-star steps in turn: each node passes its neighbours on to
    the smallest of them, until every node points at the smallest of its component.
    Steps take few rounds on long chains too, and no task holds a component.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = _lowest(both, "a", "b", "large-low").withColumn("low", F.least("low", "a"))
        large = materialize(
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .filter("a <> b").distinct(), "large-star")
        low = _lowest(large, "a", "b", "small-low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = materialize(
            small.union(low.select("a", F.col("low"))).filter("a <> b").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b"), F.col("b")).distinct())
