"""Connected components of a graph given as a table of edges, by alternating stars; only tables, nothing on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import dropped, saved

#: Far above the logarithm squared of any graph's size; reaching it means an error, not an end.
ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every node that is not the smallest of its component.

    edges: columns a, b (long), in any direction, repeats and loops allowed. Each round joins every node to its least
    neighbour (large star), then chains to their least (small star), until the table of edges is the same again. Every
    round is a written table, so a lost executor costs a task and no round. A hub of any degree is a hot join key that
    adaptive execution splits; its sums are partial before the shuffle.
    """
    now = saved(edges.select("a", "b").filter("a <> b"), "edges")
    before = None
    for _ in range(ROUNDS):
        after = saved(_small(_large(now)), "edges")
        dropped(now)
        now = after
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if mark == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
        before = mark
    raise RuntimeError("components: no fixed point")
