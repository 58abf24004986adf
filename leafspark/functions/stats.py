"""Robust statistics and labels of measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def robust_median(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """Median of the values within two median absolute deviations of the median, by group.

    Groups of at most two values, or with a deviation under 1e-9, give their plain median; null values are
    left out. Two aggregations joined back on the group key; the last one runs on the filtered rows.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("v")).filter("v is not null")
    mid = rows.groupBy(*by).agg(F.median("v").alias("med"), F.count("v").alias("n"))
    dev = rows.join(mid, by).groupBy(*by).agg(
        F.first("med").alias("med"), F.first("n").alias("n"), F.median(F.abs(F.col("v") - F.col("med"))).alias("mad")
    )
    plain = (F.col("n") <= 2) | (F.col("mad") < 1e-9)
    near = rows.join(dev, by).filter(plain | (F.abs(F.col("v") - F.col("med")) <= 2 * F.col("mad")))
    return near.groupBy(*by).agg(
        F.when(F.first(plain), F.first("med")).otherwise(F.median("v")).alias(out), F.first("n").alias("n")
    )


def sample_size(n: Column) -> Column:
    """A tenth of n, at least 10 and at most 30, and never more than n; nothing of nothing."""
    return F.when(n <= 0, F.lit(0)).otherwise(F.least(n, F.greatest(F.lit(10), F.least(F.lit(30), F.floor(n / 10))))).cast("long")


def severity(score: Column) -> Column:
    return F.when(score < 0.1, "none").when(score < 0.3, "mild").when(score < 0.6, "moderate").otherwise("severe")


def color_cast(deviation: Column) -> Column:
    return F.when(deviation < 5, "none").when(deviation < 15, "slight_warm").otherwise("strong_warm")


def majority(vote: Column) -> Column:
    """More than half of the rows; nulls count as no."""
    return F.count_if(vote) > F.count("*") / 2


def voted(vote: Column, percent: int) -> Column:
    """At least that many of a hundred rows."""
    return 100 * F.count_if(vote) >= percent * F.count("*")


def border_confidence(vertical: Column, horizontal: Column) -> Column:
    """Of the numbers of vertical and horizontal border lines found."""
    return (
        F.when((vertical >= 2) & (horizontal >= 2), 1.0)
        .when((vertical >= 2) & (horizontal == 1), 0.9)
        .when(vertical >= 2, 0.8)
        .when(vertical + horizontal == 1, 0.3)
        .otherwise(0.0)
    )


def histogram_peak(df: DataFrame, by: list[str], value: str, period: int, taps: int = 5) -> DataFrame:
    """Value of the highest circularly smoothed count, the least on ties; value is an integer in [0, period)."""
    half = taps // 2
    counts = df.groupBy(*by, F.col(value).cast("int").alias("v")).agg(F.count("*").alias("n"))
    shifts = F.explode(F.sequence(F.lit(-half), F.lit(half))).alias("d")
    spread = counts.select(*by, "v", "n", shifts).withColumn("v", F.pmod(F.col("v") + F.col("d"), F.lit(period)))
    smooth = spread.groupBy(*by, "v").agg(F.sum("n").alias("s"))
    return smooth.groupBy(*by).agg(
        F.max_by("v", F.struct("s", -F.col("v"))).alias("peak"), F.round(F.max("s") / taps, 6).alias("height")
    )


def circular_range(df: DataFrame, by: list[str], value: str, period: int) -> DataFrame:
    """Period less the largest gap between values on a circle; 0 for one distinct value."""
    v = df.select(*by, F.col(value).cast("double").alias("v")).distinct()
    w = Window.partitionBy(*by).orderBy("v")
    gaps = v.withColumn("gap", F.col("v") - F.lag("v").over(w))
    return gaps.groupBy(*by).agg(
        F.round(period - F.greatest(F.coalesce(F.max("gap"), F.lit(0.0)), period - (F.max("v") - F.min("v"))), 6).alias("extent")
    )


def least_squares(df: DataFrame, by: list[str], a: Column, b: Column, y: Column, names: tuple[str, str]) -> DataFrame:
    """Coefficients of y = c1 * a + c2 * b by normal equations: five sums, one pass."""
    m = df.select(*by, a.alias("a"), b.alias("b"), y.alias("y"))
    total = lambda x, z: F.sum(F.col(x) * F.col(z)).alias(x + z)
    s = m.groupBy(*by).agg(*[total(x, z) for x, z in ("aa", "ab", "bb", "ay", "by")])
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    return s.select(
        *by,
        ((F.col("ay") * F.col("bb") - F.col("by") * F.col("ab")) / det).alias(names[0]),
        ((F.col("by") * F.col("aa") - F.col("ay") * F.col("ab")) / det).alias(names[1]),
    )


def half_median(value: Column, least: float) -> Column:
    """Threshold at half a median, with a floor."""
    return F.greatest(F.lit(float(least)), F.round(0.5 * F.median(value), 4))
