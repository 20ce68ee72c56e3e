"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import attach_group, remove, staged_at


def _with_smallest(pairs: DataFrame, most: int) -> DataFrame:
    """Add ``m``, the smallest of ``u`` and its ``v``s, to at most ``most`` pairs. The rows of a hot ``u`` are dealt out by their ``v``."""
    smallest = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    return attach_group(pairs, smallest, ["u"], "n", ["m"], F.col("v"), most)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    marked = _with_smallest(down, n)
    own = marked.select("u", F.col("m").alias("v"))
    return own.unionByName(marked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``u``, ``v``); the root is the smallest node reachable.

    Null ends are left out; repeated edges, loops and an empty table are fine. Each round is written to the shared folder, and the one before
    it is removed: lineage stays short and a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    edges, path = staged_at(edges.filter("u <> v").distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        last = path
        edges, path = staged_at(_small_star(_large_star(edges, before[0]), 2 * before[0]), "edges")
        remove(spark, last)
        now = _digest(edges)
        if now == before:
            break
        before = now
    children = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return children.unionByName(children.select(F.col("root").alias("node"), "root").distinct())
