"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return r["n"], r["h"] or 0


def components(spark: SparkSession, links: DataFrame, most: int = 60) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for every id that has a link.

    ``links`` has columns ``a`` and ``b`` (long). Every round is stored; links stay distributed,
    and a node of many links is a row for each of them, never a list.
    """
    edges = stored(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    for _ in range(most):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stored(spark, small.union(lower.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
