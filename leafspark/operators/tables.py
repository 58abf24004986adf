"""Operators over tables of pages, stages and records: matches, numbers, matrices, settings and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the other table."""
    return df.join(gone.select(key), key, "left_anti").select(df.columns)


def within(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the other table."""
    return df.join(known.select(key), key, "left_semi").select(df.columns)


def with_records(df: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Rows with their record's columns, null where there is none."""
    return df.join(records, key, "left")


def stem(name: Column) -> Column:
    """A file's name without its last suffix."""
    return F.regexp_replace(name, r"[.][^./]*$", "")


def positions(df: DataFrame, by: list[str], order: list[str], out: str, parts: int = 64, sample_rows: int = 2048) -> DataFrame:
    """df with each row's place 0, 1, .. in its group's order; no group meets in one task.

    Rows are dealt by ranges of the first order column, whose bounds are read from a hashed sample; a place is that
    among its range, plus the counts of the ranges before. Nulls come first.
    """
    first, total = order[0], df.count()
    share = int(min(1.0, sample_rows / max(total, 1)) * (1 << 30))
    seen = df.select(F.col(first).alias("b")).filter(F.pmod(F.xxhash64("b"), F.lit(1 << 30)) < share).filter("b is not null")
    values = sorted(r["b"] for r in seen.distinct().limit(4 * sample_rows).collect())
    bounds = values[:: max(1, len(values) // parts)][1:]
    range_ = F.lit(0)
    if bounds:
        range_ = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(first))), F.lit(0))
    dealt = df.withColumn("__range", F.when(F.col(first).isNull(), F.lit(-1)).otherwise(range_))
    counts = dealt.groupBy(*by, "__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*by, "__range").orderBy(*order)) - 1
    placed = dealt.withColumn("__at", inside).join(offsets, [*by, "__range"])
    return placed.select(*df.columns, (F.col("__before") + F.col("__at")).cast("long").alias(out))


def in_order(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """place (from 1), part and key of tables laid one after the other, each by its key."""
    both = None
    for k, p in enumerate(parts):
        own = p.select(F.lit(k).alias("part"), F.col(key))
        both = own if both is None else both.unionByName(own)
    placed = positions(both, ["part"], [key], "at")
    sizes = {r["part"]: r["n"] for r in both.groupBy("part").agg(F.count("*").alias("n")).collect()}
    ahead = [sum(sizes.get(j, 0) for j in range(k)) for k in range(len(parts))]
    start = F.get(F.array(*[F.lit(n).cast("long") for n in ahead]), F.col("part"))
    return placed.select((start + F.col("at") + 1).alias("place"), "part", key)


def latest_stage(stages: DataFrame, by: str, before: int) -> DataFrame:
    """For each branch, its highest stage number under ``before``: branch, number, stage."""
    number = F.regexp_extract("stage", r"^(\d+)_", 1).cast("int")
    return stages.withColumn("number", number).filter(F.col("number") < before).groupBy(by).agg(
        F.max("number").alias("number"), F.max_by("stage", "number").alias("stage")
    )


def grid(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts by row and value; the values are given, so no pass looks for them."""
    return df.groupBy(row).pivot(column, values).count().na.fill(0, values)


def counted(df: DataFrame, by: list[str]) -> DataFrame:
    """Number of rows of each combination."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def rolled_up(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Counts and totals of all levels of a report."""
    return df.rollup(*by).agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))


def disk_budget(df: DataFrame, by: list[str], size: str, factor: int, free: Column) -> DataFrame:
    """Rows and bytes of each group, and whether a run's share of ``factor`` times those is over what is free."""
    total = F.sum(size)
    return df.groupBy(*by).agg(F.count("*").alias("n"), total.alias("bytes"), (total * factor > free).alias("too_large"))


def in_review(df: DataFrame, by: list[str], fell_back: Column, percent: int = 20) -> DataFrame:
    """Groups of which more than that share of rows fell back, with the share."""
    out = df.groupBy(*by).agg(F.count_if(fell_back).alias("bad"), F.count("*").alias("n"))
    out = out.filter(100 * F.col("bad") > percent * F.col("n"))
    return out.select(*by, F.round(100.0 * F.col("bad") / F.col("n"), 4).alias("percent"))


def printed_order(df: DataFrame, by: str, number: str, key: str) -> DataFrame:
    """Rows in the order of printed numbers, and whether a number occurs twice."""
    order = Window.partitionBy(by).orderBy(number, key)
    same = F.count("*").over(Window.partitionBy(by, number)) > 1
    return df.select("*", F.row_number().over(order).alias("place"), same.alias("duplicate"))


def expanded_ranges(spec: Column) -> Column:
    """Distinct numbers of a specification such as 0,2-4, ascending."""
    bounds = F.transform(F.split(spec, ","), lambda p: F.split(p, "-"))
    one = lambda b: F.sequence(F.get(b, F.lit(0)).cast("int"), F.element_at(b, -1).cast("int"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(bounds, one))))


def layered(name: str, default: Column, *layers: Column) -> Column:
    """A setting from the first of several maps that has it, else its default."""
    return F.coalesce(*[m[name] for m in layers], default)


def first_answer(tries: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    """Name of the first method, in order of priority, whose condition holds."""
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in tries], F.lit(otherwise))


def spread_parts(wide: Column) -> Column:
    """Names of the parts of a page: two where it is a spread."""
    return F.when(wide, F.array(F.lit("left"), F.lit("right"))).otherwise(F.array(F.lit("whole")))


def by_substring(df: DataFrame, text: str, table: DataFrame, name: str, value: str, otherwise: float) -> DataFrame:
    """df with the value of the table's row whose name the text holds; a table of at most a few thousand rows."""
    out = df.join(F.broadcast(table.select(name, value)), F.contains(F.col(text), F.col(name)), "left")
    return out.select(*df.columns, F.coalesce(F.col(value), F.lit(otherwise)).alias(value))


def nearest_two(queries: DataFrame, rows: DataFrame, by: str, key: str, vector: str, ratio: float) -> DataFrame:
    """key, nearest, d, d2 and matched of each query's two nearest rows of its group, with the ratio test."""
    a, b = queries.alias("a"), rows.alias("b")
    squares = F.zip_with(f"a.{vector}", f"b.{vector}", lambda x, y: (x - y) * (x - y))
    pairs = a.join(b, (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col(f"a.{key}") != F.col(f"b.{key}"))).select(
        F.col(f"a.{key}").alias(key), F.col(f"b.{key}").alias("nearest"),
        F.round(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x), 6).alias("d"),
    )
    w = Window.partitionBy(key).orderBy("d", "nearest")
    ranked = pairs.withColumn("rn", F.row_number().over(w)).withColumn("d2", F.lead("d").over(w)).filter("rn = 1")
    return ranked.select(key, "nearest", "d", "d2", (F.col("d") < ratio * F.col("d2")).alias("matched"))
