"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proteoframe.llm.base import store


def components(edges: DataFrame) -> DataFrame:
    """``edges``: two columns ``a``, ``b`` of long. Returns ``node``, ``root`` (smallest node of its component).

    A round hangs every larger neighbour of a node onto the node's smallest
    neighbour, then does the same among smaller ones. Minima are taken with
    map-side aggregation and joined back, so a node with many edges is never
    gathered; rounds grow with the logarithm of the longest path.
    """
    now = store(_clean(edges.select("a", "b")))
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == seen:
            break
        seen = mark
        now = store(_small_star(_large_star(now)))
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(now.select("b", "b")).distinct())


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, larger end first."""
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _clean(both.filter("b > a").join(least, "a").select("b", "m").toDF("a", "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return _clean(edges.join(least, "a").select("b", "m").toDF("a", "b").union(least.select("a", "m").toDF("a", "b")))
