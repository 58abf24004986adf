"""Gapless ranks inside groups of any size, without a group ever meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafspark.llm import store


def ranked(df: DataFrame, group: str, order: list[str], rank: str, spread: str) -> DataFrame:
    """df with rank 0, 1, .. inside each value of group.

    Rows are dealt by a hash of ``spread`` (a column of many values), numbered there, and moved up by how
    many rows of their group lie in earlier parts. The order is by part, then by ``order``; it is the same
    in every run. df is read twice: give a written table.
    """
    parts = 8 * store.shuffle_width(df.sparkSession)
    dealt = df.withColumn("__part", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    counts = dealt.groupBy("__part", group).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    offsets = store.cut(offsets, "ranks")
    inside = Window.partitionBy("__part", group).orderBy(*order)
    return (
        dealt.repartition("__part")
        .withColumn("__at", F.row_number().over(inside))
        .join(offsets, ["__part", group])
        .withColumn(rank, (F.col("__before") + F.col("__at") - 1).cast("long"))
        .drop("__part", "__at", "__before")
    )
