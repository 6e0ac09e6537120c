"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cashwatch.llm.common import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """`node, component` (the smallest node reachable) for every node of `edges` (`a, b`, longs).

    Loops and repeated edges do no harm; an edge with a null end is dropped. Each round writes
    its edges, and rounds go on until one changes nothing: its count and checksum stay.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = edges.filter("a IS NOT NULL AND b IS NOT NULL")
    loops = now.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    now = staged(now.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        before, now = now, staged(_small_star(_large_star(now)), "edges")
        discard(before, shuffles=False)  # a few edges
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    found = members.unionAll(centres)
    return found.unionAll(loops.join(found, "node", "left_anti"))
