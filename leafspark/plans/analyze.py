"""Calibration: measurements of evenly sampled photos, folded into one row of settings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafspark.functions import stats
from leafspark.functions.kernels import color, morph, page, warp
from leafspark.plans import config
from leafspark.sources.images import pixels

MEASURES = (
    "book string, stem string, hue int, saturation double, value double, rg double, rb double, lines int, aspect double, frame boolean, "
    "cast double, hotspot boolean, finger boolean, stains double, fading double, foxing double"
)


def measured(pages: DataFrame) -> DataFrame:
    """One row of numbers a photo; pixels end here."""

    def one(r: dict) -> tuple:
        img, _ = warp.limited(pixels(r), 1000)
        name, quad = page.page_outline(img)
        lo, hi = quad.min(axis=0).astype(int), quad.max(axis=0).astype(int)
        crop = img[max(lo[1], 0) : hi[1], max(lo[0], 0) : hi[0]] if name != "full_image" else img
        g = color.gray(crop)
        lines = page.line_mask(morph.adaptive_mask(g, 31))
        h, s, v = color.hsv(crop)
        at = lines if lines.sum() >= 200 else (s > 60) & (v > 60)
        if at.any():
            hist = np.bincount(h[at].astype(int) % 180, minlength=180)
            smooth = sum(np.roll(hist, k) for k in range(-2, 3))
            hue = int(np.argmax(smooth))
            rgb = np.median(crop[at], axis=0)
            ink = (hue, float(np.median(s[at])), float(np.median(v[at])), float(rgb[2] - rgb[1]), float(rgb[2] - rgb[0]))
        else:
            ink = (None, None, None, None, None)
        mask = color.ink_mask(crop)
        t, w = crop.shape[:2]
        sides = [mask[:, : int(0.18 * w)], mask[:, -int(0.18 * w) :], mask[: int(0.18 * t)], mask[-int(0.18 * t) :]]
        frame = sum(float(x.mean()) > 0.005 for x in sides if x.size) >= 3
        return (
            r["book"], r["stem"], *ink, len(page.staff_lines(mask)), round(w / max(t, 1), 4), frame, color.gray_world_deviation(img),
            float((img > 250).all(axis=-1).mean()) > 0.005, bool(page.finger_mask(img, color.ink_mask(img)).any()),
            morph.stains(g), color.fading(crop), morph.foxing(crop, mask),
        )

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEASURES.split(", ")]
        for f in frames:
            yield pd.DataFrame([one(r) for r in f.to_dict("records")], columns=names)

    return pages.filter("data is not null").mapInPandas(run, MEASURES)


def sampled(pages: DataFrame) -> DataFrame:
    """Evenly spread pages of each book; pixels do not join, only stems do."""
    from leafspark.operators.sequences import even_sample

    names = even_sample(pages.filter("data is not null").select("book", "stem", "page_seq"), ["book"], ["page_seq"])
    return pages.join(F.broadcast(names.select("book", "stem")), ["book", "stem"], "left_semi")  # 30 stems a book at most


def calibration(measures: DataFrame) -> DataFrame:
    """One row a book: ink, layout, photography and condition."""
    number = F.count("*")
    out = measures.groupBy("book").agg(
        number.alias("samples"),
        stats.majority(F.col("frame")).alias("has_border_frame"),
        F.median("lines").alias("staff_lines"),
        F.round(F.median("aspect"), 2).alias("aspect_ratio"),
        stats.color_cast(F.median("cast")).alias("color_cast"),
        stats.voted(F.col("hotspot"), 30).alias("has_flash_hotspots"),
        stats.voted(F.col("finger"), 30).alias("fingers_detected"),
        *[stats.severity(F.median(c)).alias(c) for c in ("stains", "fading", "foxing")],
    )
    for name in ("hue", "saturation", "value", "rg", "rb"):
        robust = stats.robust_median(measures, ["book"], name, name).drop("n")
        out = out.join(robust, "book", "left")
    floor = lambda c, share, least: F.greatest(F.lit(float(least)), F.round(F.col(c) * share))
    return out.withColumns({
        "sat_min": floor("saturation", 0.5, 20), "val_min": floor("value", 0.5, 40),
        "diff": F.least(floor("rg", 0.7, 15), floor("rb", 0.7, 15)),
    })


def book_toml(row: dict) -> str:
    """Settings file of a calibration; with under 3 samples the defaults."""
    if row.get("samples", 0) < 3 or row.get("hue") is None:
        return config.dump({"pipeline": {"profile": "full"}})
    return config.dump({
        "ink": {"hue": float(row["hue"]), "sat_min": row["sat_min"], "val_min": row["val_min"], "diff": row["diff"]},
        "pipeline": {"profile": "full", "fingers_detected": bool(row["fingers_detected"])},
    })


def suggested_hue(pages: DataFrame) -> DataFrame:
    """Dominant hue of each page's colored pixels: stem, peak, height."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.to_dict("records"):
                h, s, _ = color.hsv(warp.limited(pixels(r), 600)[0])
                hist = np.bincount(h[s > 60].astype(int) % 180, minlength=180)
                yield pd.DataFrame({"stem": r["stem"], "v": np.arange(180), "n": hist})

    counts = pages.filter("data is not null").mapInPandas(run, "stem string, v int, n long").filter("n > 0")
    order = Window.partitionBy("stem").orderBy(F.desc("n"), "v")
    return counts.withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("stem", F.col("v").alias("peak"), "n")
