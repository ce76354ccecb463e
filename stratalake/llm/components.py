"""Connected components of a graph given by its links, as joins and aggregates over the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the least node reachable.

    Two steps take turns until the links no longer change. The first ties the larger neighbours of
    a node to its least neighbour, the second ties the smaller ones to it. Both keep what is
    connected, and they end with every node tied to the least of its component, after a number of
    rounds that grows with the logarithm of the longest path. A node with many links is a join key
    whose rows may be split, as minima are aggregated before they are joined. Nulls and links of a
    node to itself are left out.
    """
    upper, lower = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    current = checkpointed(links.filter("a <> b").select(upper, lower).distinct())
    state = _state(current)
    while state[0]:
        both = current.select(F.col("u").alias("n"), F.col("v").alias("o")).union(
            current.select(F.col("v").alias("n"), F.col("u").alias("o"))
        )
        least = both.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = (
            both.filter("o > n").join(least, "n").select(F.col("o").alias("u"), F.col("m").alias("v"))
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
        )
        small = large.join(lowest, "u").select(F.inline(pairs)).filter("u <> v").distinct()
        current, before = checkpointed(small), state
        state = _state(current)
        if state == before:
            break
    tops = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )


def _state(links: DataFrame) -> tuple:
    """Number and hash of the links, independent of their order."""
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
    )
