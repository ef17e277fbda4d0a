"""Connected components as rounds of joins and aggregations, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(`node`, `root`) for every node of the edges (`a`, `b`); root is the smallest node reachable.

    Large-star and small-star rounds: each node's larger neighbours, then its smaller ones, are hung on
    its smallest neighbour. No list of neighbours is gathered; a node with very many is split by the
    adaptive join. Rounds stop when the edges repeat; their number grows with the logarithm of the
    largest component. No edges give no rows; loops and repeated edges change nothing.
    """
    now = written(_down(edges.select("a", "b")))
    mark = _mark(now)
    while True:
        now = written(_small_star(_large_star(now)))
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node; no loops."""
    return (
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free sum of hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _down(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(hung.union(least.select("a", "m")))
