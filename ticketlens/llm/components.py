"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest one around it."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    near = both.where("b > a").join(least, "a")
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """``row`` and ``root`` for every vertex of an edge, the root being the component's smallest.

    Alternates the two star operations, each a join and an aggregation, until the edges no longer change;
    the rounds grow with the logarithm of the longest chain. Each round is a written table, so that none
    is ever computed again.
    """
    now, last, turn = edges.select("a", "b").where("a <> b").distinct(), None, 0
    now = scratch.write(now, f"{name}-{turn}")
    while True:
        digest = F.sum(F.shiftright(F.xxhash64("a", "b"), 20))
        state = tuple(now.agg(F.count("*"), digest).first())
        if state == last:
            break
        last, turn = state, turn + 1
        now = scratch.write(_small_star(_large_star(now)).distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
    roots = now.select(F.col("a").alias("row"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("row"), F.col("b").alias("root")).distinct())
