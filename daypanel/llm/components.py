"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import materialise


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of the component.

    Each round replaces edges by edges to smaller neighbours; the number of edges doesn't
    grow, and a node with many neighbours is only ever reduced to a minimum (map-side first)
    and joined, never gathered.  Rounds end when the edges don't change.  Loops and null ends
    are dropped; no edges give no rows.
    """
    e = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialise(e)
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        e = materialise(small)
        new = _state(e)
        if new == state:
            break
        state = new
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())
