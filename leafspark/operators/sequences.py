"""Operators over ordered pages: sampling, neighbour groups, gap clusters, as-of matches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafspark.functions.stats import sample_size
from leafspark.operators.tables import positions


def even_sample(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows at index trunc(i * (N - 1) / (n - 1)) of each group's order, with n by ``sample_size``.

    The wanted indices come from an explode of n values, so only sampled rows join; places come from counts of
    ranges, so a hot group is spread.
    """
    numbered = positions(df, by, order, "at")
    sizes = df.groupBy(*by).agg(F.count("*").alias("total")).withColumn("n", sample_size(F.col("total")))
    index = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i")
    wanted = sizes.filter("n > 0").select(*by, "total", "n", index).select(
        *by, F.when(F.col("n") == 1, F.lit(0)).otherwise(F.floor(F.col("i") * (F.col("total") - 1) / (F.col("n") - 1))).alias("at")
    )
    return numbered.join(wanted.distinct(), [*by, "at"])


def neighbour_groups(df: DataFrame, by: list[str], order: list[str], linked: Column) -> DataFrame:
    """df with group_no: rows linked to the one before them share its group.

    Edges join neighbours only, so components are runs: a running count of breaks, no graph search.
    ``linked`` may use lag_<c> of every column c.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    back = df.select("*", *[F.lag(c).over(w).alias(f"lag_{c}") for c in df.columns if c not in by])
    fresh = F.when(F.coalesce(linked, F.lit(False)), 0).otherwise(1)
    return back.withColumn("group_no", F.sum(fresh).over(w.rowsBetween(Window.unboundedPreceding, 0))).select(*df.columns, "group_no")


def with_manual_groups(df: DataFrame, key: str, group: str, manual: DataFrame) -> DataFrame:
    """Groups from a table of overrides (key, manual_group); rows it lacks are groups of their own."""
    return df.join(manual, key, "left").withColumn(group, F.coalesce("manual_group", F.col(key).cast("string"))).drop("manual_group")


def gap_clusters(df: DataFrame, by: list[str], at: str, weight: str, gap: float) -> DataFrame:
    """Clusters of positions no more than gap apart: count, total weight, weighted position."""
    w = Window.partitionBy(*by).orderBy(at, weight)
    fresh = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    marked = df.withColumn("f", fresh).withColumn("cluster", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "cluster").agg(
        F.count("*").alias("n"), F.sum(weight).alias("weight"), (F.sum(F.col(at) * F.col(weight)) / F.sum(weight)).alias("position")
    )


def running_mean_clusters(values: Column, within: float) -> Column:
    """Clusters of a sorted array: a value joins while it is within reach of the cluster's running mean.

    The rule depends on order and is no gap rule, so it is one fold over the array.
    """
    zero = F.array().cast("array<struct<n:int,total:double>>")

    def step(acc: Column, v: Column) -> Column:
        tail = F.try_element_at(acc, F.lit(-1))
        more = F.struct((tail["n"] + 1).alias("n"), (tail["total"] + v).alias("total"))
        fresh = F.struct(F.lit(1).alias("n"), v.alias("total"))
        joins = (F.size(acc) > 0) & (F.abs(v - tail["total"] / tail["n"]) <= within)
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(more))).otherwise(F.concat(acc, F.array(fresh)))

    return F.aggregate(values, zero, step)


def latest_before(left: DataFrame, right: DataFrame, key: str, at: str, when: str, value: str) -> DataFrame:
    """For each left row, the right row of its key with the greatest ``when`` not over ``at``.

    Both sides lie in one order of time, and a left row takes the last right row before it: one shuffle, no pairs.
    Ties go to the greater value.
    """
    rows = right.filter(F.col(when).isNotNull()).select(
        key, F.col(when).cast("timestamp").alias("__t"), F.lit(0).alias("__side"), F.struct(when, value).alias("__best"),
        F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("__row"),
    )
    asks = left.select(
        key, F.col(at).cast("timestamp").alias("__t"), F.lit(1).alias("__side"),
        F.lit(None).cast(right.select(F.struct(when, value)).schema[0].dataType).alias("__best"), F.struct(*left.columns).alias("__row"),
    )
    order = Window.partitionBy(key).orderBy("__t", "__side", F.col(f"__best.{value}"))
    last = F.last("__best", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = rows.unionByName(asks).withColumn("__found", last).filter("__side = 1")
    return found.select("__row.*", F.col(f"__found.{when}").alias(when), F.col(f"__found.{value}").alias(value))


def stale_from_change(df: DataFrame, by: list[str], order: str, changed: Column) -> DataFrame:
    """df with stale: this or an earlier step of its list has changed."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("stale", F.max(F.when(F.coalesce(changed, F.lit(True)), 1).otherwise(0)).over(w) == 1)


def best_of(df: DataFrame, by: list[str], score: str, key: str) -> DataFrame:
    """Key and score of each group's highest score, the least key on ties."""
    return df.groupBy(*by).agg(F.max_by(key, F.struct(score, -F.col(key))).alias(key), F.max(score).alias(score))


def without_retakes(sharpness: Sequence[float], same: Callable[[int, int], bool]) -> list[bool]:
    """Which of a group's shots, in order, stay: of each two kept ones that are the ``same``, the less sharp goes.

    Every shot meets all later ones; ties keep the first, and a dropped shot takes no further part.
    """
    keep = [True] * len(sharpness)
    for i in range(len(keep)):
        for j in range(i + 1, len(keep)):
            if keep[i] and keep[j] and same(i, j):
                keep[j if sharpness[i] >= sharpness[j] else i] = False
    return keep
