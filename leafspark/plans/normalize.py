"""Pages of a book brought to one background and size: the one step that looks at the whole book."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafspark.functions.kernels import color, warp
from leafspark.sources.images import PAGE, as_row, pixels


def backgrounds(pages: DataFrame) -> DataFrame:
    """book, stem, width, height and background color of each page."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(r["book"], r["stem"], r["width"], r["height"], *map(float, color.border_color(pixels(r)))) for r in f.to_dict("records")]
            yield pd.DataFrame(rows, columns=["book", "stem", "width", "height", "b", "g", "r"])

    kept = pages.filter("data is not null and channels = 3")
    return kept.mapInPandas(run, "book string, stem string, width int, height int, b double, g double, r double")


def normalized(pages: DataFrame) -> DataFrame:
    """Every color page scaled to its book's median background and resized to its median size.

    Pixels are read twice and never shuffled: a page is met by one row of its book, which is broadcast. The
    rows are as many as books; a collection of a million of them would be 50 MB.
    """
    book = backgrounds(pages).groupBy("book").agg(*[F.median(c).alias(f"m_{c}") for c in ("width", "height", "b", "g", "r")])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                img = pixels(r)
                scale = np.array([r["m_b"], r["m_g"], r["m_r"]]) / np.maximum(color.border_color(img), 1)
                out = np.clip(np.rint(img * scale), 0, 255).astype(np.uint8)
                out = warp.resize(out, int(r["m_width"]), int(r["m_height"]))
                meta = json.dumps({"stage": "normalize", "scale": scale.round(4).tolist()})
                rows.append(as_row({k: r[k] for k in PAGE.names}, out, stage="11_normalize", meta=meta, status="processed"))
            yield pd.DataFrame(rows, columns=PAGE.names)

    kept = pages.filter("data is not null and channels = 3")
    return kept.join(F.broadcast(book), "book").mapInPandas(run, PAGE)


def split_spreads(pages: DataFrame, ratio: float = 1.5) -> DataFrame:
    """Pages wider than ``ratio`` heights become two, left before right."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                img = pixels(r)
                half = img.shape[1] // 2
                parts = [("", img)] if img.shape[1] <= ratio * img.shape[0] else [("_l", img[:, :half]), ("_r", img[:, half:])]
                rows += [as_row(r, part, stem=r["stem"] + tail) for tail, part in parts]
            yield pd.DataFrame(rows, columns=PAGE.names)

    return pages.filter("data is not null").select(PAGE.names).mapInPandas(run, PAGE)
