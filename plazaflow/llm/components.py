"""Connected components of a graph of integer nodes, by stars that shrink in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plazaflow.llm.common import discard, written


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), the component being its smallest node.

    A large star ties each node's larger neighbours to its smallest one, a small star its smaller
    neighbours and itself; in turn they leave one star per component. Minima are combined before
    the shuffle and joined back, so a node with very many neighbours is not gathered.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while seen != (now := _print(e)):
        seen = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-star")
        discard(e)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        e = written(small.distinct(), "small-star")
        discard(large)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
