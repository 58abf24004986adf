"""Stages of a page's way from photo to book, each a function of image, record and settings.

Consecutive stages of a page run in one Arrow pass (``run_pages``): an image is decoded once, and only the last
result and the records of all stages leave the worker. A page that fails keeps its input, its status says
so, and a critical stage's failure excludes the page.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafspark.functions.kernels import color, features, morph, page, warp
from leafspark.functions.kernels import enhance as enhance_kernels
from leafspark.operators import sequences
from leafspark.plans.config import Config
from leafspark.sources.images import PAGE, as_row, pixels

Stage = Callable[[np.ndarray, dict, Config], tuple[np.ndarray, dict]]


def preprocess(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    """Glare filled from around it; fingers too, where the book has them."""
    mask = morph.hotspots(img)
    share = float(mask.mean())
    out = dict(meta) | {"stage": "preprocess", "hotspot_detected": share > 0.005}
    if share > 0.005:
        img, out["hotspot_area_frac"] = morph.inpaint(img, mask), round(share, 6)
    if cfg.fingers_detected:
        finger = page.finger_mask(img, color.ink_mask(img, **cfg.ink()))
        out["finger_removed"] = bool(finger.any())
        if finger.any():
            img = morph.inpaint(img, morph.dilate(finger, 9))
    return img, out


def orientation(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    turns, method = page.turn(img, **cfg.ink())
    img = np.ascontiguousarray(np.rot90(img, turns))
    focus = morph.laplacian_variance(color.gray(img), 0.8)
    return img, {
        "stage": "orientation", "rotation_applied": turns * 90, "orientation_method": method,
        "focus_score": round(focus, 4), "focus_threshold": 100.0, "is_blurry": focus < 100,
    }


def lens_correct(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    out = warp.undistort(img, cfg.lens_k1, cfg.lens_k2)
    return out, {"stage": "lens_correct", "k1": cfg.lens_k1, "k2": cfg.lens_k2, "focal_length_px": max(img.shape[:2])}


def _expanded(quad: np.ndarray, w: int, h: int, share: float) -> np.ndarray:
    edge = np.linalg.norm(quad - np.roll(quad, 1, axis=0), axis=1).mean()
    away = quad - quad.mean(axis=0)
    moved = quad + away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-9) * share * edge
    stays = (quad <= 5).any(axis=1) | (quad[:, 0] >= w - 5) | (quad[:, 1] >= h - 5)
    return np.clip(np.where(stays[:, None], quad, moved), 0, [w, h])


def page_detect(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    """Corners of the page; the pixels stay."""
    h, w = img.shape[:2]
    method, quad = page.page_outline(img, cfg.page_method, cfg.page_min_area)
    out = {"stage": "page_detect", "method": method, "page_type": page.page_type(img, **cfg.ink())}
    if cfg.border_refinement and method != "full_image":
        lines = page.border_lines(img, cfg.ink_hue, cfg.ink_hue_range)
        upright = sum(lines[k] is not None for k in ("left", "right"))
        flat = sum(lines[k] is not None for k in ("top", "bottom"))
        sure = (1.0, 0.9, 0.8)[2 - flat] if upright == 2 else 0.3 if upright + flat == 1 else 0.0
        if sure >= cfg.border_confidence:
            left, right = lines["left"], lines["right"]
            x = quad[:, 0]
            x = np.where(left - x > 0.04 * w, left - 0.02 * w, x)
            quad[:, 0] = np.where(x - right > 0.04 * w, right + 0.02 * w, x)
        out["border_refinement"] = {"confidence": sure, **lines}
    quad = page.order_corners(quad) if method == "full_image" else page.order_corners(_expanded(quad, w, h, cfg.page_expand))
    return img, out | {"quad_corners": quad.round(3).tolist()}


def _quad(meta: dict) -> np.ndarray | None:
    q = meta.get("quad_corners")
    return np.array(q, float) if isinstance(q, list) and np.shape(q) == (4, 2) else None


def gentle_crop(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    h, w = img.shape[:2]
    out, quad = {"stage": "gentle_crop", "page_type": meta.get("page_type", "unknown"), "margin_frac": cfg.crop_margin}, _quad(meta)
    if quad is None:
        return img, out | {"method": "pass_through", "crop_box": [0, 0, w, h]}
    lo, hi = np.floor(quad.min(axis=0)).astype(int), np.ceil(quad.max(axis=0)).astype(int)
    pad = (cfg.crop_margin * (hi - lo)).astype(int)
    lo, hi = np.maximum(lo - pad, 0), np.minimum(hi + pad, [w, h])
    box = [int(v) for v in (*lo, *hi)]
    return img[box[1] : box[3], box[0] : box[2]], out | {"method": "quad", "crop_box": box, "quad_corners": (quad - lo).tolist()}


def content_area(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    kind = meta.get("page_type", "unknown")
    out = {"stage": "content_area", "page_type": kind}
    if kind == "blank":
        return img, out | {"method": "pass_through"}
    h, w = img.shape[:2]
    method, rect = page.content_rect(img, cfg.content_inset, **cfg.ink())
    x0, y0, x1, y1 = rect
    outside = np.ones((h, w), bool)
    outside[y0:y1, x0:x1] = False
    fill = np.median(img[outside].reshape(-1, *img.shape[2:]), axis=0).astype(int) if outside.any() else color.border_color(img)
    img = page.feathered(img, rect, fill, cfg.content_feather)[y0:y1, x0:x1]
    pad = int((x1 - x0) * cfg.content_padding)
    if pad:
        wide = np.empty((img.shape[0] + 2 * pad, img.shape[1] + 2 * pad, *img.shape[2:]), np.uint8)
        wide[:] = fill
        wide[pad:-pad, pad:-pad] = img
        img = wide
    return img, out | {"method": method, "content_rect": list(rect), "margin_px": pad, "background_color": np.atleast_1d(fill).tolist()}


def staff_extract(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    """The band of rows that holds staff lines."""
    h, w = img.shape[:2]
    m = morph.opened(page.ink_or_dark(img, **cfg.ink()), max(w // 8, 50), 1)
    _, box = morph.components(m)
    key, reason, wide = "staff_extract_", None, box[box[:, 2] - box[:, 0] >= 0.3 * w]
    if not len(box):
        reason = "no_lines"
    elif not len(wide):
        reason = "no_wide_lines"
    else:
        pad = max(10, h // 50)
        y0, y1 = max(0, int(wide[:, 1].min()) - pad), min(h, int(wide[:, 3].max()) + pad)
        if y1 - y0 < 0.5 * h:
            reason = "region_too_small"
    if reason:
        return img, dict(meta) | {f"{key}action": "pass_through", f"{key}reason": reason}
    found = {"action": "cropped", "method": "line_mask", "y_start": y0, "y_end": y1, "lines_found": len(wide), "coverage": round((y1 - y0) / h, 4)}
    return img[y0:y1], dict(meta) | {key + k: v for k, v in found.items()}


def deskew(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    method, angle = page.skew(img, cfg.deskew_max_angle, cfg.deskew_step, **cfg.ink())
    angle = float(np.clip(angle, -cfg.deskew_max_angle, cfg.deskew_max_angle))
    out, quad = {"stage": "deskew", "page_type": meta.get("page_type", "unknown"), "method": method}, _quad(meta)
    if abs(angle) < cfg.deskew_skip_below:
        return img, out | {"method": "skipped", "skew_angle": 0.0} | ({"quad_corners": quad.tolist()} if quad is not None else {})
    fill = color.border_color(img)
    turned, m = warp.rotate(img, angle, fill)
    turned, x, y = warp.trim(turned, fill)
    if quad is not None:
        out["quad_corners"] = (warp.project(m, quad) - [x, y]).tolist()
    return turned, out | {"skew_angle": round(angle, 4)}


def perspective(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    out, quad = {"stage": "perspective", "page_type": meta.get("page_type", "unknown")}, _quad(meta)
    h, w = img.shape[:2]
    side = lambda a, b: float(np.linalg.norm(quad[a] - quad[b]))
    reason = "no_quad" if quad is None else None
    if quad is not None:
        tw, th = round(max(side(0, 1), side(3, 2))), round(max(side(0, 3), side(1, 2)))
        angle = lambda a, b: float(np.degrees(np.arctan2(quad[b, 1] - quad[a, 1], quad[b, 0] - quad[a, 0])))
        skew = max(abs(angle(0, 1)), abs(angle(3, 2)))
        crop = max(0.0, 1 - page.polygon_area(quad) / (w * h))
        inner = []
        for i in range(4):
            a, b = quad[i - 1] - quad[i], quad[(i + 1) % 4] - quad[i]
            cos = a @ b / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-9)
            inner.append(abs(np.degrees(np.arccos(np.clip(cos, -1, 1))) - 90))
        out |= {"src_quad": quad.tolist(), "dst_size": [tw, th], "skew_degrees": round(skew, 4), "crop_ratio": round(crop, 4), "angle_deviation": round(float(max(inner)), 4)}
        if min(tw, th) < 10:
            reason = "too_small"
        elif skew > cfg.perspective_max_skew:
            reason = "skew_too_large"
        elif crop > cfg.perspective_max_crop:
            reason = "crop_too_large"
        elif max(inner) < cfg.perspective_near_rect:
            reason = "near_rectangular"
        else:
            m = warp.homography(quad, np.array([[0, 0], [tw, 0], [tw, th], [0, th]], float))
            tilt = float(np.degrees(np.arctan2(m[1, 0], m[0, 0])))
            own = (angle(0, 1) + angle(3, 2)) / 2
            if abs(tilt + own) > cfg.perspective_max_tilt:
                reason = "introduced_tilt"
    if reason:
        return img, out | {"method": "pass_through", "skip_reason": reason}
    fill = color.border_color(img)
    return warp.warp(img, m, tw, th, fill), out | {"method": "warp", "background_color": np.atleast_1d(fill).tolist()}


def dewarp(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    return enhance_kernels.dewarped(img, **cfg.ink()), dict(meta) | {"stage": "dewarp"}


def enhance(img: np.ndarray, meta: dict, cfg: Config) -> tuple[np.ndarray, dict]:
    return enhance_kernels.enhanced(img, cfg.enhance), dict(meta) | {"stage": "enhance", "steps": list(cfg.enhance)}


#: Number, error class and function of the stages that work page by page.
PAGE_STAGES: dict[str, tuple[int, str, Stage]] = {
    "preprocess": (0, "skippable", preprocess), "orientation": (2, "critical", orientation),
    "lens_correct": (3, "skippable", lens_correct), "page_detect": (4, "skippable", page_detect),
    "gentle_crop": (5, "skippable", gentle_crop), "content_area": (6, "skippable", content_area),
    "staff_extract": (7, "skippable", staff_extract), "deskew": (8, "skippable", deskew),
    "perspective": (9, "skippable", perspective), "dewarp": (10, "skippable", dewarp), "enhance": (12, "skippable", enhance),
}
COMMON, BOOK, SCORE = ("orientation", "lens_correct", "page_detect", "gentle_crop"), ("deskew", "perspective", "dewarp", "enhance"), ("content_area", "staff_extract", "deskew")


def run_pages(pages: DataFrame, names: list[str], cfg: Config) -> DataFrame:
    """All named stages in one pass; a row for each page and stage, pixels only at the last one."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.to_dict("records"):
                if row["data"] is None or row["height"] is None or row["height"] <= 0:
                    continue
                img, meta, out, state = pixels(row), json.loads(row["meta"] or "{}"), [], "ok"
                for name in names:
                    number, error, stage = PAGE_STAGES[name]
                    why = None
                    try:
                        img, meta = stage(img, meta, cfg)
                        state = "processed"
                    except Exception as e:  # noqa: BLE001 one bad page must not end the book
                        if error == "critical":
                            out.append(dict(row) | {"stage": f"{number:02d}_{name}", "data": None, "status": "excluded", "error": repr(e), "meta": None})
                            break
                        state, why, meta = "failed", repr(e), {}
                    last = name == names[-1]
                    made = as_row(row, img, stage=f"{number:02d}_{name}", meta=json.dumps(meta, default=str), status=state, error=why)
                    out.append(made if last else made | {"data": None})
                if out:
                    yield pd.DataFrame(out, columns=PAGE.names)

    return pages.mapInPandas(run, PAGE)


def last_of(results: DataFrame) -> DataFrame:
    """Pages that carry pixels: what the next phase reads."""
    return results.filter("data is not null")


def shot_features(pages: DataFrame) -> DataFrame:
    """stem, page_seq, focus, dark share, and the described corners for matching."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for row in f.to_dict("records"):
                img = pixels(row)
                d = features.described(img)
                rows.append((row["book"], row["stem"], row["page_seq"], morph.laplacian_variance(color.gray(img)), color.dark_share(img), d.h, d.w, d.points.astype("<i4").tobytes(), d.bits.tobytes()))
            yield pd.DataFrame(rows, columns=["book", "stem", "page_seq", "focus", "dark", "h", "w", "points", "bits"])

    kept = pages.filter("data is not null")
    return kept.mapInPandas(run, f"book string, stem string, page_seq long, focus double, dark double, {DESCRIBED}")


DESCRIBED = "h int, w int, points binary, bits binary"


def described(row: dict, prefix: str = "") -> features.Described:
    h, w, points, bits = (row[prefix + c] for c in ("h", "w", "points", "bits"))
    return features.Described(int(h), int(w), np.frombuffer(points, "<i4").reshape(-1, 2), np.frombuffer(bits, np.uint8).reshape(-1, 32))


def page_groups(shots: DataFrame, cfg: Config) -> DataFrame:
    """book, stem, group_id and kept: shots of one page; corners meet their neighbour's, and then their group's.

    Excluded stems and covers are left out; of each two kept shots of a group that show the same, the less sharp is
    not kept. A group is a few shots, so its corners fit a task.
    """
    kept = shots.filter(~F.col("stem").isin(list(cfg.exclude))) if cfg.exclude else shots
    if not cfg.include_covers:
        kept = kept.filter("dark <= 0.8")
    w = Window.partitionBy("book").orderBy("page_seq")
    names = ("stem", "h", "w", "points", "bits")
    pairs = kept.select("*", *[F.lag(c).over(w).alias(f"p_{c}") for c in names])

    def match(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                link = False
                if r["p_bits"] is not None and r["stem"] not in cfg.no_stitch and r["p_stem"] not in cfg.no_stitch:
                    found = features.compared(described(r, "p_"), described(r))
                    link = features.linked(found, cfg.stitch_min_matches, cfg.stitch_min_inliers, cfg.stitch_min_overlap)
                rows.append((r["book"], r["stem"], r["page_seq"], r["focus"], r["h"], r["w"], r["points"], r["bits"], link))
            yield pd.DataFrame(rows, columns=["book", "stem", "page_seq", "focus", "h", "w", "points", "bits", "link"])

    linked = pairs.mapInPandas(match, f"book string, stem string, page_seq long, focus double, {DESCRIBED}, link boolean")
    auto = sequences.neighbour_groups(linked, ["book"], ["page_seq"], F.col("link"))
    first = F.first("stem").over(Window.partitionBy("book", "group_no").orderBy("page_seq"))
    out = auto.withColumn("group_id", first)
    if cfg.stitch_groups:
        named = [(stem, group[0]) for group in cfg.stitch_groups for stem in group]
        manual = F.broadcast(shots.sparkSession.createDataFrame(named, "stem string, manual_group string"))
        out = sequences.with_manual_groups(auto, "stem", "group_id", manual)

    def retakes(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("page_seq")
        shots = [described(r) for r in g.to_dict("records")]

        def same(i: int, j: int) -> bool:
            found = features.compared(shots[i], shots[j])
            return found["matches"] >= cfg.stitch_min_matches and found["overlap"] >= cfg.retake_overlap

        keep = sequences.without_retakes(g["focus"].tolist(), same)
        return g.assign(kept=keep)[["book", "stem", "group_id", "focus", "kept"]]

    return out.groupBy("book", "group_id").applyInPandas(retakes, "book string, stem string, group_id string, focus double, kept boolean")


def stitch(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """One page a group: its kept shots joined in order, or the sharpest where they do not fit."""
    kept = groups.filter("kept").select("book", "stem", "group_id", "focus")
    both = pages.join(kept, ["book", "stem"])

    def run(g: pd.DataFrame) -> pd.DataFrame:
        rows = g.sort_values("page_seq").to_dict("records")
        imgs, method = [pixels(r) for r in rows], "single"
        out = imgs[0]
        for other in imgs[1:]:
            joined = features.stitched(out, other)
            if joined is None:
                out, method = imgs[int(np.argmax([r["focus"] for r in rows]))], "sharpest"
                break
            out, method = joined, "homography"
        meta = {"stage": "stitch", "group": [r["stem"] for r in rows], "stitch_method": method, "stitch_success": method != "sharpest"}
        base = {k: rows[0][k] for k in PAGE.names}
        return pd.DataFrame([as_row(base, out, stage="01_stitch", meta=json.dumps(meta), status="processed")], columns=PAGE.names)

    # A group is a few shots of one page, so its pixels fit a task.
    return both.groupBy("book", "group_id").applyInPandas(run, PAGE)
