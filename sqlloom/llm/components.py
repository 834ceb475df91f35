"""Connected components of a link table by alternating large-star and small-star steps.

Each step groups by a vertex and takes a minimum (partial aggregates, so a vertex with very many
links sends one row a task) and joins it back. Steps are written tables; the loop ends when a step
changes nothing, after about log(diameter) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sqlloom.sources.scratch import RunScratch


def components(links: DataFrame, scratch: RunScratch, label: str) -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (a, b): root is the least vertex reachable."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.write(edges.distinct(), f"{label}-0")
    before, step = _state(edges), 0
    while before[0]:
        large = _star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = _star(large, larger=False)
        step += 1
        edges = scratch.write(small.distinct(), f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}")
        after = _state(edges)
        if after == before:
            break
        before = after
    # Now every vertex but a root has one link, to its root.
    roots = edges.select(F.col("b").alias("vertex"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots.distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: link the larger neighbours of each ``a`` to the least of its neighbourhood.
    Small star: link ``a`` and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = edges.join(least, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
