"""Connected components by alternating large and small stars; edges never leave the executors.

Both stars keep the components and draw edges towards the least node, until each edge ends there. Minima are
pre-aggregated before their shuffle and written before they are joined back, so that a node with very many
edges can be split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store


def _star(pairs: DataFrame, name: str) -> DataFrame:
    """pairs u, v: for each u, its least neighbour or itself as m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(store.cut(least, name), "u")


def _round(now: DataFrame) -> DataFrame:
    """Edges u > v after one large and one small star."""
    both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(both, "large").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = store.cut(large.filter("u > v").distinct(), "edges")
    small = _star(large, "small")
    small = small.select(F.col("u"), F.col("m").alias("v")).unionByName(
        small.select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return store.cut(small.filter("u > v").distinct(), "edges")


def _tidy(edges: DataFrame) -> DataFrame:
    tidy = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    return store.cut(tidy.distinct(), "edges")


def contracted(edges: DataFrame) -> DataFrame:
    """node and label after one round: equal labels are connected, connected nodes may still differ."""
    with store.scratch(edges.sparkSession):
        now = _round(_tidy(edges)).groupBy("u").agg(F.min("v").alias("v"))
        return store.cut(now.select(F.col("u").alias("node"), F.col("v").alias("label")), "labels", keep=True)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and label (the component's least node) of every node of edges a, b but the least ones."""
    with store.scratch(edges.sparkSession):
        now, seen = _tidy(edges), None
        for _ in range(rounds):
            now = _round(now)
            mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).collect()[0]
            if mark == seen:
                break
            seen = mark
        else:
            raise RuntimeError("components did not settle")
        return store.cut(now.select(F.col("u").alias("node"), F.col("v").alias("label")), "labels", keep=True)
