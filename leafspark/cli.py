"""Command line: stages, run, analyze, diagnose, compare, publish, flipbook, inspect."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import functions as F

from leafspark.plans import analyze, config, diagnose, planner, stages
from leafspark.session import session
from leafspark.sources import documents, images


def _settings(args: argparse.Namespace) -> config.Config:
    path = os.path.join(args.input, "book.toml")
    text = open(path).read() if os.path.exists(path) else None  # noqa: SIM115
    cfg, odd = config.load(text, profile=getattr(args, "profile", None), preview=getattr(args, "preview", None))
    for name in odd:
        print(f"unknown setting: {name}", file=sys.stderr)
    return cfg


def _records(result: dict):
    return result["records"].filter("meta is not null").select("branch", "stage", "stem", F.col("meta").alias("record"))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="leafspark")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("stages")
    for name in ("run", "analyze", "diagnose", "compare", "publish", "flipbook", "inspect"):
        s = sub.add_parser(name)
        s.add_argument("input")
        s.add_argument("--output")
        s.add_argument("--profile", choices=sorted(config.PROFILES))
        s.add_argument("--preview", type=int)
        s.add_argument("--json", action="store_true")
    args = p.parse_args(argv)
    if args.command == "stages":
        for name, (number, error, _) in stages.PAGE_STAGES.items():
            print(f"{number:2} {name:14} {error}")
        return 0
    spark = session("leafspark")
    name = os.path.basename(os.path.abspath(args.input))
    out = args.output or f"{args.input.rstrip('/')}_output"
    pages = images.read_pages(spark, args.input, name)
    if args.command == "analyze":
        rows = analyze.calibration(analyze.measured(analyze.sampled(pages))).collect()
        text = analyze.book_toml(rows[0].asDict() if rows else {})
        with open(os.path.join(args.input, "book.toml"), "w") as f:
            f.write(text)
        print(text)
        return 0
    if args.command == "inspect":
        for r in analyze.suggested_hue(pages).orderBy("stem").collect():
            print(r["stem"], r["peak"], r["n"])
        return 0
    cfg = _settings(args)
    result = planner.Book(spark, out, name).run(pages, cfg)
    os.makedirs(out, exist_ok=True)
    book = result.get("book", result[""])
    if args.command == "run":
        print(planner.report(result["records"]))
        path = os.path.join(out, f"{name}.pdf")
        made = documents.write_pdf(book, None, path, cfg.pdf_dpi, compression=cfg.pdf_compression, quality=cfg.pdf_jpeg_quality)
        print(json.dumps(made))
        failed = result["records"].filter("status in ('failed', 'excluded')").count()
        return 1 if failed and cfg.on_error == "stop" else 0
    if args.command == "diagnose":
        print(diagnose.rendered(_records(result), args.json))
    elif args.command == "publish":
        documents.publish(book, os.path.join(out, "published"))
    elif args.command == "flipbook":
        documents.flipbook(book, os.path.join(out, "flipbook"), cfg.flipbook_max_width, cfg.flipbook_jpeg_quality, cfg.flipbook_title or name)
    else:
        sources = {}
        for branch in ("", "book", "score"):
            if branch in result:
                sources |= documents.publish(result[branch], os.path.join(out, "images"))
        rows = documents.viewer_model(_records(result)).orderBy("stem").toLocalIterator()
        model = [
            {"stem": r["stem"], "stages": [
                {"stage": x["stage"], "meta": x["record"]} | ({"src": f"images/{src}"} if (src := sources.get((x["branch"], x["stage"], r["stem"]))) else {})
                for x in r["stages"]
            ]} for r in rows
        ]
        with open(os.path.join(out, "compare.html"), "w") as f:
            f.write(documents.viewer_html(name, model))
    return 0


if __name__ == "__main__":
    sys.exit(main())
