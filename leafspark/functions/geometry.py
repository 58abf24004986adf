"""Quadrilaterals as four points (arrays of structs x, y): order top left, top right, bottom right, bottom left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = ("tl", "tr", "br", "bl")


def bound(value: Column, body) -> Column:
    """body(value) with value evaluated once a row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _least(points: Column, key) -> Column:
    """Point of the least key, the first on ties."""
    keyed = F.transform(points, lambda p, i: F.struct(key(p).alias("k"), i.alias("i"), p.alias("p")))
    return F.array_min(keyed)["p"]


def order_corners(points: Column) -> Column:
    """Four points in corner order; null unless there are four."""
    made = F.array(
        _least(points, lambda p: p["x"] + p["y"]),
        _least(points, lambda p: p["y"] - p["x"]),
        _least(points, lambda p: -(p["x"] + p["y"])),
        _least(points, lambda p: -(p["y"] - p["x"])),
    )
    return F.when(F.size(points) == 4, made)


def edge(quad: Column, a: int, b: int) -> Column:
    p, q = F.get(quad, F.lit(a)), F.get(quad, F.lit(b))
    return F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))


def area(quad: Column) -> Column:
    def term(a: int, b: int) -> Column:
        p, q = F.get(quad, F.lit(a)), F.get(quad, F.lit(b))
        return p["x"] * q["y"] - q["x"] * p["y"]

    return F.abs(term(0, 1) + term(1, 2) + term(2, 3) + term(3, 0)) / 2


def target_size(quad: Column) -> tuple[Column, Column]:
    """Width and height of the upright page: the longer of opposite edges, halves to even."""
    return (
        F.bround(F.greatest(edge(quad, 0, 1), edge(quad, 3, 2))).cast("long"),
        F.bround(F.greatest(edge(quad, 0, 3), edge(quad, 1, 2))).cast("long"),
    )


def edge_angle(quad: Column, a: int, b: int) -> Column:
    p, q = F.get(quad, F.lit(a)), F.get(quad, F.lit(b))
    return F.degrees(F.atan2(q["y"] - p["y"], q["x"] - p["x"]))


def skew(quad: Column) -> Column:
    """Larger absolute angle of the top and bottom edges."""
    return F.greatest(F.abs(edge_angle(quad, 0, 1)), F.abs(edge_angle(quad, 3, 2)))


def tilt(quad: Column) -> Column:
    """Mean signed angle of the top and bottom edges."""
    return (edge_angle(quad, 0, 1) + edge_angle(quad, 3, 2)) / 2


def angle_deviation(quad: Column) -> Column:
    """Largest distance of an interior angle from a right one."""

    def inner(i: int) -> Column:
        p, a, b = (F.get(quad, F.lit(k % 4)) for k in (i, i + 3, i + 1))
        ax, ay, bx, by = a["x"] - p["x"], a["y"] - p["y"], b["x"] - p["x"], b["y"] - p["y"]
        cos = (ax * bx + ay * by) / (F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by))
        return F.abs(F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos)))) - 90)

    return F.greatest(*[inner(i) for i in range(4)])


def crop_ratio(quad: Column, width: Column, height: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - area(quad) / (width * height))


def at_boundary(quad: Column, width: Column, height: Column, margin: float = 5) -> Column:
    """Number of corners within the margin of the image's edge."""
    near = lambda p: (p["x"] <= margin) | (p["y"] <= margin) | (p["x"] >= width - margin) | (p["y"] >= height - margin)
    return F.size(F.filter(quad, near))


def expand(quad: Column, width: Column, height: Column, share: float = 0.05, margin: float = 5) -> Column:
    """Corners moved away from the centre by a share of the mean edge; those at the boundary stay; clipped."""

    def centre(q: Column) -> Column:
        total = lambda c: sum((F.get(q, F.lit(i))[c] for i in range(4)), F.lit(0.0))
        mean = (edge(q, 0, 1) + edge(q, 1, 2) + edge(q, 2, 3) + edge(q, 3, 0)) / 4
        return F.struct(mean.alias("mean"), (total("x") / 4).alias("x"), (total("y") / 4).alias("y"))

    def moved(p: Column, c: Column) -> Column:
        dx, dy = p["x"] - c["x"], p["y"] - c["y"]
        r = F.sqrt(dx * dx + dy * dy)
        stays = (p["x"] <= margin) | (p["y"] <= margin) | (p["x"] >= width - margin) | (p["y"] >= height - margin) | (r < 1e-9)
        clip = lambda v, top: F.greatest(F.lit(0.0), F.least(top.cast("double"), v))
        x, y = clip(p["x"] + dx / r * share * c["mean"], width), clip(p["y"] + dy / r * share * c["mean"], height)
        return F.when(stays, p).otherwise(point(x, y))

    return bound(quad, lambda q: bound(centre(q), lambda c: F.transform(q, lambda p: moved(p, c))))


def clip_to_borders(quad: Column, left: Column, right: Column, width: Column, over: float = 0.04, keep: float = 0.02) -> Column:
    """Corners that overshoot a left or right border line by over a share of the width come back to near it."""

    def side(x: Column) -> Column:
        low = F.when(left - x > over * width, left - keep * width)
        high = F.when(x - right > over * width, right + keep * width)
        return F.coalesce(low, high, x)

    return F.transform(quad, lambda p: point(side(p["x"]), p["y"]))


def crop_box(quad: Column, width: Column, height: Column, share: float = 0.03) -> Column:
    """Bounding box with a margin, clamped to the image, as x0, y0, x1, y1."""
    xs, ys = F.transform(quad, lambda p: p["x"]), F.transform(quad, lambda p: p["y"])
    mx = F.floor(share * (F.array_max(xs) - F.array_min(xs)))
    my = F.floor(share * (F.array_max(ys) - F.array_min(ys)))
    return F.struct(
        F.greatest(F.lit(0), F.floor(F.array_min(xs)) - mx).cast("long").alias("x0"),
        F.greatest(F.lit(0), F.floor(F.array_min(ys)) - my).cast("long").alias("y0"),
        F.least(width.cast("long"), F.ceil(F.array_max(xs)) + mx).cast("long").alias("x1"),
        F.least(height.cast("long"), F.ceil(F.array_max(ys)) + my).cast("long").alias("y1"),
    )


def inset(width: Column, height: Column, share: float = 0.05) -> Column:
    dx, dy = F.floor(share * width), F.floor(share * height)
    return F.struct(dx.alias("x0"), dy.alias("y0"), (width - dx).alias("x1"), (height - dy).alias("y1"))


def warp_reason(quad: Column, width: Column, height: Column, max_skew: float = 5, max_crop: float = 0.3, right: float = 2) -> Column:
    """Why a page is not warped, the first reason that holds; null where it is."""
    w, h = target_size(quad)
    return (
        F.when((w < 10) | (h < 10), "too_small")
        .when(skew(quad) > max_skew, "skew_too_large")
        .when(crop_ratio(quad, width, height) > max_crop, "crop_too_large")
        .when(angle_deviation(quad) < right, "near_rectangular")
    )
