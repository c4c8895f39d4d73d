"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablerich.session import cut_lineage


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the component is its smallest node.

    Each round ties the neighbours of a node to the smallest of them: first the larger ones, then the smaller
    ones. Trees get flat in a number of rounds that grows with the logarithm of their depth. The smallest
    neighbours are written before they are joined, so a node with very many links can be split between tasks.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = cut_lineage(edges, "links")
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        edges = cut_lineage(_star(edges, larger=True), "large_star")
        edges = cut_lineage(_star(edges, larger=False), "small_star")
        state, before = _state(edges), state
        if state == before:
            break
    else:
        raise RuntimeError("components do not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does: a star round that moves none is the last."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    least = cut_lineage(least, "least")
    joined = both.join(least, F.col("u") == F.col("node"))
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v").distinct()
