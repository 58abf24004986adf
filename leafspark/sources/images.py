"""Page images as tables: reading photos with their EXIF data, decoding, and writing PNG files.

A page is a row: book, branch, stage, stem, page_seq, height, width, channels, data (unsigned bytes, blue green
red), meta (JSON text), status and error. Pixels stay in executors and never cross a shuffle.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafspark.functions.kernels import warp
from leafspark.operators import tables
from leafspark.sources.jpeg import encode_jpeg

SUFFIXES = ("png", "jpg", "jpeg", "tiff", "tif")
PAGE = T.StructType(
    [
        T.StructField("book", T.StringType()), T.StructField("branch", T.StringType()), T.StructField("stage", T.StringType()),
        T.StructField("stem", T.StringType()), T.StructField("page_seq", T.LongType()), T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()), T.StructField("channels", T.IntegerType()), T.StructField("data", T.BinaryType()),
        T.StructField("meta", T.StringType()), T.StructField("status", T.StringType()), T.StructField("error", T.StringType()),
    ]
)
#: EXIF tags that are kept, by number.
TAGS = {
    0x010F: "make", 0x0110: "model", 0x0112: "orientation", 0x829A: "exposure_time", 0x829D: "f_number", 0x8827: "iso",
    0x9003: "datetime_original", 0x920A: "focal_length", 0xA002: "pixel_width", 0xA003: "pixel_height", 0xA405: "focal_length_35mm",
}


def exif(content: bytes) -> dict:
    """Fields of the first TIFF header of a JPEG or TIFF file; rationals as numbers."""
    at = content.find(b"Exif\x00\x00")
    base = at + 6 if at >= 0 else 0
    order = {b"II": "<", b"MM": ">"}.get(content[base : base + 2])
    if order is None or content[:2] not in (b"\xff\xd8", b"II", b"MM"):
        return {}
    sizes, out = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 9: 4, 10: 8}, {}

    def read(fmt: str, place: int) -> tuple:
        return struct.unpack_from(order + fmt, content, base + place)

    def directory(place: int, depth: int = 0) -> None:
        for k in range(read("H", place)[0]):
            entry = place + 2 + 12 * k
            tag, kind, count = read("HHI", entry)
            if tag == 0x8769 and depth == 0:
                directory(read("I", entry + 8)[0], 1)
            elif tag in TAGS and kind in sizes:
                where = entry + 8 if sizes[kind] * count <= 4 else read("I", entry + 8)[0]
                if kind == 2:
                    value = content[base + where : base + where + count].split(b"\0")[0].decode("latin-1").strip()
                elif kind in (5, 10):
                    n, d = read("II" if kind == 5 else "ii", where)
                    value = n / d if d else None
                else:
                    value = read({1: "B", 3: "H", 4: "I", 7: "B", 9: "i"}[kind], where)[0]
                out[TAGS[tag]] = value

    try:
        directory(read("I", 4)[0])
    except struct.error:
        pass
    return out


def encode_png(img: np.ndarray, level: int = 1) -> bytes:
    """Lossless file of an image (gray, or blue green red)."""
    h, w = img.shape[:2]
    raw = img[..., ::-1] if img.ndim == 3 else img
    rows = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(raw).reshape(h, -1)], axis=1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 2 if img.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + chunk(b"IEND", b"")


def pixels(row: dict | pd.Series) -> np.ndarray:
    shape = (row["height"], row["width"], row["channels"])
    return np.frombuffer(row["data"], np.uint8).reshape(shape if row["channels"] > 1 else shape[:2])


def as_row(row: dict, img: np.ndarray, **changes) -> dict:
    h, w = img.shape[:2]
    img = np.ascontiguousarray(img)
    return dict(row) | {"height": h, "width": w, "channels": img.shape[2] if img.ndim == 3 else 1, "data": img.tobytes()} | changes


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """path, stem, length and page_seq of a folder's images, by name; no pixel is read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.withColumn("name", name).filter(F.lower(F.element_at(F.split("name", r"\."), -1)).isin(list(SUFFIXES)))
    placed = tables.positions(kept, [], ["name"], "at")
    return placed.select("path", tables.stem(F.col("name")).alias("stem"), "length", (F.col("at") + 1).alias("page_seq"))


def read_exif(spark: SparkSession, folder: str) -> DataFrame:
    """path, EXIF fields as JSON text, and orientation (1 where there is none) of a folder's files."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [exif(bytes(c)) for c in f["content"]]
            turned = [int(x.get("orientation") or 1) for x in found]
            yield pd.DataFrame({"path": f["path"], "exif": [json.dumps(x) for x in found], "orientation": turned})

    # A header lies in a file's first 64 KB; pixels of JPEG files are not sent to Python.
    files = spark.read.format("binaryFile").load(folder).select("path", F.substring("content", 1, 1 << 16).alias("content"))
    return files.mapInPandas(run, "path string, exif string, orientation int")


def _uprighted(pages: DataFrame) -> DataFrame:
    """Pages turned and mirrored as their EXIF orientation (a column) says."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                turns = r.pop("orientation")
                rows.append(as_row(r, warp.exif_upright(pixels(r), turns)))
            yield pd.DataFrame(rows, columns=PAGE.names)

    return pages.mapInPandas(run, PAGE)


def read_pages(spark: SparkSession, folder: str, book: str) -> DataFrame:
    """Pages of a folder, upright by their EXIF data; undecodable files have status 'unreadable' and no pixels.

    Only pages that are to be turned go through Python.
    """
    names = list_images(spark, folder)
    img = spark.read.format("image").option("dropInvalid", False).load(folder).select("image.*")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    joined = names.join(img, plain("path") == plain("origin")).join(read_exif(spark, folder), "path")
    ok = F.col("width") > 0
    pages = joined.select(
        F.lit(book).alias("book"), F.lit("").alias("branch"), F.lit("input").alias("stage"), "stem", "page_seq",
        "height", "width", F.col("nChannels").alias("channels"), "data",
        F.when(F.col("exif") == "{}", F.lit("{}")).otherwise(F.concat(F.lit('{"exif": '), F.col("exif"), F.lit("}"))).alias("meta"),
        F.when(ok, "ok").otherwise("unreadable").alias("status"), F.lit(None).cast("string").alias("error"), "orientation",
    )
    turned = (F.col("orientation").between(2, 8)) & (F.col("status") == "ok")
    return pages.filter(~turned).drop("orientation").unionByName(_uprighted(pages.filter(turned)))


KEYS = ("book", "branch", "stage", "stem", "page_seq")


def as_files(pages: DataFrame, side: int = 0, quality: int = 90, dpi: int = 300, width: int = 0, lossless: bool = False) -> DataFrame:
    """Keys, width, height, channels and file of readable pages: JPEG, or PNG where ``lossless``.

    Images are made smaller where their longer side is over ``side``, or their width over ``width``; made in executors.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                img = pixels(r)
                if side:
                    img = warp.limited(img, side)[0]
                if width and img.shape[1] > width:
                    img = warp.resize(img, width, max(1, img.shape[0] * width // img.shape[1]))
                img = np.ascontiguousarray(img)
                made = encode_png(img) if lossless else encode_jpeg(img, quality, dpi)
                rows.append((*[r[k] for k in KEYS], img.shape[1], img.shape[0], img.shape[2] if img.ndim == 3 else 1, made))
            yield pd.DataFrame(rows, columns=[*KEYS, "width", "height", "channels", "file"])

    kept = pages.filter("data is not null and status <> 'unreadable'").select(*KEYS, "height", "width", "channels", "data")
    kind = "book string, branch string, stage string, stem string, page_seq long, width int, height int, channels int, file binary"
    return kept.mapInPandas(run, kind)
