"""Book documents: PDF files, sidecar records, HTML viewers and flipbooks."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from html import escape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafspark.operators import tables
from leafspark.sources import images
from leafspark.sources.images import pixels


class PdfFile:
    """A PDF written page by page: what is held are the places of its objects, not their bytes."""

    def __init__(self, path: str, dpi: int = 300):
        self.out, self.dpi = open(path, "wb"), dpi  # noqa: SIM115 closed by close()
        self.places: dict[int, int] = {}
        self.kids: list[int] = []
        self.out.write(b"%PDF-1.4\n%\xe2\xe3\xcf\xd3\n")

    def _object(self, number: int, *body: bytes) -> None:
        self.places[number] = self.out.tell()
        for part in (f"{number} 0 obj\n".encode(), *body, b"\nendobj\n"):
            self.out.write(part)

    def add(self, width: int, height: int, channels: int, data: bytes, coding: str) -> None:
        """One page an image, sized by the resolution; coding is DCTDecode (a JPEG file) or FlateDecode."""
        n = 3 + 3 * len(self.kids)
        x, y = width * 72 / self.dpi, height * 72 / self.dpi
        space = "DeviceRGB" if channels == 3 else "DeviceGray"
        self._object(n, f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {x:.4f} {y:.4f}] /Resources << /XObject << /I {n + 1} 0 R >> >> /Contents {n + 2} 0 R >>".encode())
        head = f"<< /Type /XObject /Subtype /Image /Width {width} /Height {height} /ColorSpace /{space} /BitsPerComponent 8 /Filter /{coding} /Length {len(data)} >>\nstream\n"
        self._object(n + 1, head.encode(), data, b"\nendstream")
        draw = f"q {x:.4f} 0 0 {y:.4f} 0 0 cm /I Do Q"
        self._object(n + 2, f"<< /Length {len(draw)} >>\nstream\n{draw}\nendstream".encode())
        self.kids.append(n)

    def close(self) -> int:
        """Size of the finished file."""
        self._object(1, b"<< /Type /Catalog /Pages 2 0 R >>")
        self._object(2, f"<< /Type /Pages /Kids [{' '.join(f'{k} 0 R' for k in self.kids)}] /Count {len(self.kids)} >>".encode())
        start = self.out.tell()
        table = "".join(f"{self.places[k]:010d} 00000 n \n" for k in sorted(self.places))
        n = len(self.places) + 1
        self.out.write(f"xref\n0 {n}\n0000000000 65535 f \n{table}trailer\n<< /Size {n} /Root 1 0 R >>\nstartxref\n{start}\n%%EOF\n".encode())
        size = self.out.tell()
        self.out.close()
        return size


def flate(pages: DataFrame) -> DataFrame:
    """As ``images.as_files``, with raw pixels packed losslessly."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw = [(r, pixels(r)) for r in f.to_dict("records")]
            made = [zlib.compress(np.ascontiguousarray(i[..., ::-1] if i.ndim == 3 else i).tobytes(), 6) for _, i in raw]
            yield pd.DataFrame([(r["stem"], r["page_seq"], r["width"], r["height"], r["channels"], d) for (r, _), d in zip(raw, made)],
                               columns=["stem", "page_seq", "width", "height", "channels", "file"])

    kept = pages.filter("data is not null and status <> 'unreadable'")
    return kept.mapInPandas(run, "stem string, page_seq long, width int, height int, channels int, file binary")


def write_pdf(
    book: DataFrame, annex: DataFrame | None, path: str, dpi: int = 300, exclude: list[str] | None = None,
    compression: str = "jpeg", quality: int = 90,
) -> dict:
    """Book pages, then score annex, each in page order, as one file.

    Executors encode the pages; what reaches the driver is one encoded page after the other, each written at once.
    """
    if compression not in ("jpeg", "flate"):
        raise ValueError("compression is jpeg or flate")
    coding = "DCTDecode" if compression == "jpeg" else "FlateDecode"
    out, counts = PdfFile(path, dpi), []
    for part in (book, annex):
        if part is None:
            continue
        if exclude:
            names = [(e,) for e in {*exclude, *[e.rsplit(".", 1)[0] for e in exclude]}]
            part = tables.without(part, part.sparkSession.createDataFrame(names, "stem string"), "stem")
        files = images.as_files(part, quality=quality, dpi=dpi) if compression == "jpeg" else flate(part)
        n = 0
        for r in files.orderBy("page_seq", "stem").toLocalIterator():
            out.add(r["width"], r["height"], r["channels"], r["file"], coding)
            n += 1
        counts.append(n)
    size = out.close()
    if not sum(counts):
        os.remove(path)
        return {"page_count": 0, "score_annex_count": 0, "file_size_bytes": 0, "message": "no pages"}
    return {"page_count": sum(counts), "score_annex_count": sum(counts[1:]), "compression": compression, "dpi": dpi, "file_size_bytes": size}


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """branch, stage, stem and record of the JSON files of a book; texts that are no JSON objects are left out."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("wholetext", True)
    files = reader.text(folder)
    parts = F.split(F.input_file_name(), "/")
    rows = files.select(F.col("value").alias("record"), parts.alias("p"))
    valid = F.schema_of_variant(F.try_parse_json("record")).startswith("OBJECT")
    stage = F.element_at("p", -2)
    return rows.filter(valid & stage.rlike(r"^\d\d_")).select(
        F.when(F.element_at("p", -3).isin("book", "score"), F.element_at("p", -3)).otherwise("").alias("branch"),
        stage.alias("stage"), F.regexp_replace(F.element_at("p", -1), r"\.json$", "").alias("stem"), "record",
    )


def viewer_model(sidecars: DataFrame) -> DataFrame:
    """A row for each stem with the records of all stages in order, null where a stage lacks it."""
    stages = sidecars.select("branch", "stage").distinct()
    grid = sidecars.select("stem").distinct().crossJoin(F.broadcast(stages))  # stages of a book number a few dozen
    full = grid.join(sidecars, ["branch", "stage", "stem"], "left")
    item = F.struct("stage", "branch", "record")
    return full.groupBy("stem").agg(F.array_sort(F.collect_list(item)).alias("stages"))


PAGE = """<!doctype html><meta charset="utf-8"><title>{title}</title><style>body{{font-family:sans-serif;margin:1em}}
main{{display:flex;gap:1em;overflow:auto}}img{{max-height:80vh}}pre{{font-size:11px;max-width:30em;white-space:pre-wrap}}</style>
<h1>{title}</h1><nav><button id="p">previous</button> <b id="n"></b> <button id="f">next</button></nav><main id="m"></main>
<script>const d={data};let i=+(location.hash.slice(1)||0);function show(){{const x=d[i];location.hash=i;
document.getElementById("n").textContent=x.stem;document.getElementById("m").innerHTML="";for(const s of x.stages){{
const b=document.createElement("section");const t=document.createElement("h2");t.textContent=s.stage;b.append(t);
if(s.src){{const g=new Image();g.src=s.src;b.append(g)}}const q=document.createElement("pre");q.textContent=s.meta||"";b.append(q);
document.getElementById("m").append(b)}}}}document.getElementById("p").onclick=()=>{{i=(i+d.length-1)%d.length;show()}};
document.getElementById("f").onclick=()=>{{i=(i+1)%d.length;show()}};onkeydown=e=>{{if(e.key=="ArrowLeft")p.click();if(e.key=="ArrowRight")f.click()}};
if(d.length)show()</script>"""


def viewer_html(title: str, images: list[dict]) -> str:
    """Viewer of images (stem and stages with src and meta)."""
    return PAGE.format(title=escape(title), data=json.dumps(images).replace("</", "<\\/"))


def publish(pages: DataFrame, folder: str, side: int = 1600, quality: int = 85) -> dict[tuple[str, str, str], str]:
    """JPEG files of pages whose longer side is cut down to a limit, by branch, stage and stem; files there stay."""
    os.makedirs(folder, exist_ok=True)
    name = F.concat_ws("_", F.when(F.col("branch") != "", F.col("branch")), "stage", F.concat("stem", F.lit(".jpg")))
    named = pages.filter("data is not null").withColumn("name", name)
    names = {(r["branch"], r["stage"], r["stem"]): r["name"] for r in named.select("branch", "stage", "stem", "name").toLocalIterator()}
    there = pages.sparkSession.createDataFrame([(f,) for f in os.listdir(folder)], "name string")
    for r in images.as_files(tables.without(named, there, "name").drop("name"), side, quality).toLocalIterator():
        with open(os.path.join(folder, names[r["branch"], r["stage"], r["stem"]]), "wb") as f:
            f.write(r["file"])
    return names


BOOK = """<!doctype html><meta charset="utf-8"><title>{title}</title><style>body{{margin:0;background:#333;color:#eee;font-family:sans-serif;text-align:center}}
main{{display:flex;justify-content:center;height:92vh}}img{{max-width:50vw;max-height:92vh;object-fit:contain;background:#fff}}</style>
<main><img id="l"><img id="r"></main><p><button id="b">back</button> <b id="n"></b> <button id="f">on</button></p>
<script>const p={pages};let i=0;const e=x=>document.getElementById(x);function show(){{for(const[k,j]of[["l",i-1],["r",i]]){{e(k).style.visibility=
p[j]?"visible":"hidden";if(p[j])e(k).src=p[j]}}e("n").textContent=(i+1)+" / "+p.length}}e("b").onclick=()=>{{i=Math.max(0,i-2);show()}};
e("f").onclick=()=>{{i=Math.min(p.length-p.length%2,i+2);show()}};onkeydown=x=>{{if(x.key=="ArrowLeft")e("b").click();if(x.key=="ArrowRight")e("f").click()}};show()</script>"""


def flipbook(pages: DataFrame, folder: str, max_width: int = 1600, quality: int = 85, title: str = "") -> dict:
    """Numbered JPEG files, flipbook.json and a page that turns them; the size is the middle page's, by place."""
    os.makedirs(folder, exist_ok=True)
    names, sizes = [], []
    for r in images.as_files(pages, quality=quality, width=max_width).orderBy("page_seq", "stem").toLocalIterator():
        names.append(f"{len(names) + 1:03d}.jpg")
        sizes.append((r["width"], r["height"]))
        with open(os.path.join(folder, names[-1]), "wb") as f:
            f.write(r["file"])
    width, height = sizes[len(sizes) // 2] if sizes else (0, 0)
    model = {"title": title, "pages": names, "page_count": len(names), "width": width, "height": height}
    with open(os.path.join(folder, "flipbook.json"), "w") as f:
        json.dump(model, f)
    with open(os.path.join(folder, "index.html"), "w") as f:
        f.write(BOOK.format(title=escape(title), pages=json.dumps(names)))
    return model
