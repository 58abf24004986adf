"""Overlap of two shots: corners, binary patches, matches, a homography, and their joint image."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from leafspark.functions.kernels import color, morph, warp


STRIP = 512


def corners(gray: np.ndarray, edge: int = 17, most: int = 2000) -> np.ndarray:
    """Strongest corners, at least 4 pixels apart, away from the edge; found in strips, which bounds memory."""
    h, found = gray.shape[0], []
    for top in range(0, h, STRIP):
        lo = max(0, top - 16)
        gx, gy = morph.sobel(gray[lo : top + STRIP + 16])
        a, b, c = (morph.mean_blur(v, 5) for v in (gx * gx, gy * gy, gx * gy))
        r = a * b - c * c - 0.04 * (a + b) ** 2
        peak = r == morph._slide(morph._slide(r, 9, 1, np.maximum, -np.inf), 9, 0, np.maximum, -np.inf)
        peak[:, :edge], peak[:, -edge:] = False, False
        y, x = np.nonzero(peak & (r > 0))
        mine = (y + lo >= max(top, edge)) & (y + lo < min(top + STRIP, h - edge))
        found.append(np.column_stack([x, y + lo, r[y, x]])[mine])
    all_ = np.concatenate(found)
    all_ = all_[all_[:, 2] > 0.001 * all_[:, 2].max(initial=0)]
    return all_[np.argsort(-all_[:, 2], kind="stable")[:most], :2].astype(int)


def describe(gray: np.ndarray, points: np.ndarray, seed: int = 9) -> np.ndarray:
    """256 comparisons of smoothed values around each point, between pixels too, as bits."""
    pairs = np.random.default_rng(seed).integers(-15, 16, (256, 4))
    s = morph.gaussian(gray, 2.0)

    def at(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
        x, y = points[:, :1] + dx, points[:, 1:] + dy
        i, j = (np.clip(np.floor(v).astype(int), 0, n - 2) for v, n in ((x, s.shape[1]), (y, s.shape[0])))
        u, v = x - i, y - j
        return (s[j, i] * (1 - u) + s[j, i + 1] * u) * (1 - v) + (s[j + 1, i] * (1 - u) + s[j + 1, i + 1] * u) * v

    if not len(points):
        return np.zeros((0, 32), np.uint8)
    return np.packbits(at(pairs[:, 0], pairs[:, 1]) < at(pairs[:, 2], pairs[:, 3]), axis=1)


def matches(a: np.ndarray, b: np.ndarray, ratio: float = 0.75) -> np.ndarray:
    """Pairs of rows whose nearest is clearly nearer than the second nearest."""
    if len(a) == 0 or len(b) < 2:
        return np.zeros((0, 2), int)
    near, ok = [], []
    for i in range(0, len(a), 256):
        d = np.bitwise_count(a[i : i + 256, None] ^ b[None]).sum(axis=2, dtype=np.int64)
        rows, first = np.arange(len(d)), d.argmin(axis=1)
        d1 = d[rows, first]
        d[rows, first] = 1 << 30
        near.append(first)
        ok.append(d1 < ratio * d.min(axis=1))
    hit = np.flatnonzero(np.concatenate(ok))
    return np.column_stack([hit, np.concatenate(near)[hit]])


def robust_homography(src: np.ndarray, dst: np.ndarray, within: float = 5.0, rounds: int = 300, seed: int = 3) -> tuple[np.ndarray | None, np.ndarray]:
    """Homography of the most points, and which those are; the same in every run."""
    rng, best = np.random.default_rng(seed), np.zeros(len(src), bool)
    if len(src) < 4:
        return None, best
    for _ in range(rounds):
        pick = rng.choice(len(src), 4, replace=False)
        with np.errstate(all="ignore"):
            err = np.linalg.norm(warp.project(warp.homography(src[pick], dst[pick]), src) - dst, axis=1)
        ok = err < within
        if ok.sum() > best.sum():
            best = ok
    return (warp.homography(src[best], dst[best]) if best.sum() >= 4 else None), best


@dataclass
class Described:
    """Size of an image, its corners, and their descriptors."""

    h: int
    w: int
    points: np.ndarray
    bits: np.ndarray


def described(img: np.ndarray, side: int = 500) -> Described:
    """Corners are those of the full image; each is described where it lies in a copy of that side, as larger
    surroundings tell corners better apart."""
    gray = color.gray(img)
    small, k = warp.limited(gray, side)
    points = corners(gray, int(np.ceil(17 / k)))
    return Described(*gray.shape[:2], points, describe(small, (points + 0.5) * k - 0.5))


def compared(a: Described, b: Described) -> dict:
    """Matches, share of inliers, share of b that a covers, and the homography from a to b."""
    m = matches(a.bits, b.bits)
    h, ok = robust_homography(a.points[m[:, 0]].astype(float), b.points[m[:, 1]].astype(float)) if len(m) else (None, np.zeros(0, bool))
    share = 0.0
    if h is not None:
        p = warp.project(h, np.array([[0, 0], [a.w, 0], [a.w, a.h], [0, a.h]], float))
        lo, hi = np.clip(p.min(axis=0), 0, [b.w, b.h]), np.clip(p.max(axis=0), 0, [b.w, b.h])
        share = float(np.prod(hi - lo) / (b.h * b.w))
    return {"matches": len(m), "inliers": float(ok.mean()) if len(ok) else 0.0, "overlap": share, "matrix": h}


def overlap(a: np.ndarray, b: np.ndarray) -> dict:
    """What ``compared`` says of two images."""
    return compared(described(a), described(b))


def linked(found: dict, least: int = 30, inliers: float = 0.5, share: float = 0.15) -> bool:
    return found["matches"] >= least and found["inliers"] >= inliers and found["overlap"] >= share


def stitched(first: np.ndarray, second: np.ndarray, most: int = 10_000) -> np.ndarray | None:
    """The second shot warped into the first's frame, halves where both are; null if they don't fit."""
    found = overlap(second, first)
    if found["matrix"] is None or found["inliers"] < 0.5:
        return None
    m = found["matrix"]
    h, w = second.shape[:2]
    p = np.vstack([warp.project(m, np.array([[0, 0], [w, 0], [w, h], [0, h]], float)), [[0, 0], [first.shape[1], first.shape[0]]]])
    lo, hi = np.floor(p.min(axis=0)).astype(int), np.ceil(p.max(axis=0)).astype(int)
    if (hi - lo).max() > most or (hi - lo).min() < 1:
        return None
    shift = np.array([[1, 0, -lo[0]], [0, 1, -lo[1]], [0, 0, 1]], float)
    out = warp.warp(second, shift @ m, hi[0] - lo[0], hi[1] - lo[1], np.zeros(3))
    y, x = -lo[1], -lo[0]
    view = out[y : y + first.shape[0], x : x + first.shape[1]]
    both = (view.max(axis=-1, keepdims=True) > 0) & (first.max(axis=-1, keepdims=True) > 0)
    view[:] = np.where(both, (view.astype(int) + first) // 2, np.maximum(view, first))
    return out
