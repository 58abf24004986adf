"""Small rasters stored as arrays, row by row: moments, stencils, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pixels(df: DataFrame, key: str, raster: str, width: int) -> DataFrame:
    """A row for each pixel: key, x, y, v."""
    flat = df.select(key, F.posexplode(raster).alias("i", "v"))
    return flat.select(key, (F.col("i") % width).alias("x"), F.floor(F.col("i") / width).cast("int").alias("y"), F.col("v").cast("double").alias("v"))


def laplacian_variance(raster: Column, width: int, height: int) -> Column:
    """Population variance of the four-neighbour Laplacian over inner pixels, inside the row."""
    inner = [y * width + x for y in range(1, height - 1) for x in range(1, width - 1)]
    at = lambda i: F.get(raster, i).cast("double")
    response = F.transform(
        F.array(*[F.lit(i) for i in inner]), lambda i: at(i - 1) + at(i + 1) + at(i - width) + at(i + width) - 4 * at(i)
    )
    n = len(inner)
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    bind = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    return bind(response, lambda r: bind(add(r) / n, lambda m: add(F.transform(r, lambda x: (x - m) * (x - m))) / n))


def laplacian_focus(px: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """The same from pixel rows: each pixel is sent to its neighbours, so one aggregation replaces four joins."""
    moves = [(0, 0, -4), (1, 0, 1), (-1, 0, 1), (0, 1, 1), (0, -1, 1)]
    shift = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy"), F.lit(w).alias("w")) for x, y, w in moves])).alias("m")
    sent = px.select(key, "x", "y", "v", shift).select(
        key, (F.col("x") + F.col("m.dx")).alias("x"), (F.col("y") + F.col("m.dy")).alias("y"), (F.col("v") * F.col("m.w")).alias("v")
    )
    inner = sent.filter(F.col("x").between(1, width - 2) & F.col("y").between(1, height - 2))
    return inner.groupBy(key, "x", "y").agg(F.sum("v").alias("r")).groupBy(key).agg(F.var_pop("r").alias("focus"))


def profile_variance(px: DataFrame, key: str) -> DataFrame:
    """Population variance of row sums, the score of a deskew angle."""
    return px.groupBy(key, "y").agg(F.sum("v").alias("s")).groupBy(key).agg(F.var_pop("s").alias("score"))


def page_class(mean: Column, spread: Column, lines: Column) -> Column:
    return (
        F.when(lines >= 4, "music").when((spread < 15) & (mean > 200), "blank").when(spread < 20, "other").otherwise("text")
    )


def otsu(px: DataFrame, key: str, value: str = "v") -> DataFrame:
    """Threshold of greatest between-class variance over a 256-bin histogram, the least on ties."""
    from pyspark.sql import Window

    hist = px.groupBy(key, F.col(value).cast("int").alias("t")).agg(F.count("*").alias("n"))
    up = Window.partitionBy(key).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy(key)
    s = hist.select(
        key, "t", F.sum("n").over(up).cast("double").alias("n0"), F.sum(F.col("n") * F.col("t")).over(up).cast("double").alias("s0"),
        F.sum("n").over(all_).cast("double").alias("n1"), F.sum(F.col("n") * F.col("t")).over(all_).cast("double").alias("s1"),
    ).filter("n0 < n1")
    apart = F.col("s0") / F.col("n0") - (F.col("s1") - F.col("s0")) / (F.col("n1") - F.col("n0"))
    scored = s.withColumn("score", F.round(F.col("n0") * (F.col("n1") - F.col("n0")) * apart * apart / (F.col("n1") * F.col("n1")), 6))
    return scored.groupBy(key).agg(F.max_by("t", F.struct("score", -F.col("t"))).alias("threshold"), F.max("score").alias("score"))


def normalized(df: DataFrame, key: str, raster: str) -> DataFrame:
    """Each raster scaled so that its median meets the median of all rasters' medians.

    One row of global state, broadcast: its size is fixed.
    """
    med = df.select(key, F.explode(raster).alias("v")).groupBy(key).agg(F.median(F.col("v").cast("double")).alias("med"))
    book = med.agg(F.median("med").alias("book"))
    return med.crossJoin(F.broadcast(book)).select(key, "med", "book", (F.col("book") - F.col("med")).alias("shift"))
