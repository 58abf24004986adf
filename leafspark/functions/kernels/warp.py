"""Geometric changes of a page, bilinear, with a fill color outside."""

from __future__ import annotations

import numpy as np

#: EXIF orientation: quarter turns counter-clockwise after an optional left-right flip.
TURNS = {1: (0, False), 2: (0, True), 3: (2, False), 4: (2, True), 5: (1, True), 6: (3, False), 7: (3, True), 8: (1, False)}


def exif_upright(img: np.ndarray, orientation: int) -> np.ndarray:
    turns, flip = TURNS.get(orientation, (0, False))
    return np.ascontiguousarray(np.rot90(img[:, ::-1] if flip else img, turns))


def sample(img: np.ndarray, x: np.ndarray, y: np.ndarray, fill: np.ndarray) -> np.ndarray:
    """Image values at real-valued places."""
    h, w = img.shape[:2]
    src = img.reshape(h, w, -1).astype(np.float32)
    inside = (x > -1) & (y > -1) & (x < w) & (y < h)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    fx, fy = (x - x0)[..., None], (y - y0)[..., None]

    def at(yy: np.ndarray, xx: np.ndarray) -> np.ndarray:
        ok = (xx >= 0) & (yy >= 0) & (xx < w) & (yy < h)
        got = src[np.clip(yy, 0, h - 1), np.clip(xx, 0, w - 1)]
        return np.where(ok[..., None], got, fill)

    top = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx
    low = at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    out = np.where(inside[..., None], top * (1 - fy) + low * fy, fill)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8).reshape(*x.shape, *img.shape[2:])


def homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """3 x 3 matrix that takes four or more points to others, by least squares."""
    rows, rhs = [], []
    for (x, y), (u, v) in zip(src, dst):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        rhs += [u, v]
    h = np.linalg.lstsq(np.array(rows, float), np.array(rhs, float), rcond=None)[0]
    return np.append(h, 1).reshape(3, 3)


def project(matrix: np.ndarray, points: np.ndarray) -> np.ndarray:
    p = np.column_stack([points, np.ones(len(points))]) @ matrix.T
    return p[:, :2] / p[:, 2:]


def warp(img: np.ndarray, matrix: np.ndarray, width: int, height: int, fill: np.ndarray) -> np.ndarray:
    """The image under a homography (source to target)."""
    inverse = np.linalg.inv(matrix)
    y, x = np.mgrid[0:height, 0:width].astype(np.float64)
    d = inverse[2, 0] * x + inverse[2, 1] * y + inverse[2, 2]
    u = (inverse[0, 0] * x + inverse[0, 1] * y + inverse[0, 2]) / d
    v = (inverse[1, 0] * x + inverse[1, 1] * y + inverse[1, 2]) / d
    return sample(img, u, v, fill)


def rotation(width: int, height: int, degrees: float) -> np.ndarray:
    """Matrix of a turn about the centre, counter-clockwise as seen."""
    t = np.radians(degrees)
    c, s, cx, cy = np.cos(t), np.sin(t), width / 2, height / 2
    return np.array([[c, s, (1 - c) * cx - s * cy], [-s, c, s * cx + (1 - c) * cy], [0, 0, 1]])


def rotate(img: np.ndarray, degrees: float, fill: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, w = img.shape[:2]
    m = rotation(w, h, degrees)
    return warp(img, m, w, h, fill), m


def undistort(img: np.ndarray, k1: float, k2: float) -> np.ndarray:
    """Radial lens correction; the focal length is the longer side."""
    h, w = img.shape[:2]
    f = max(w, h)
    y, x = np.mgrid[0:h, 0:w].astype(np.float64)
    u, v = (x - w / 2) / f, (y - h / 2) / f
    r2 = u * u + v * v
    k = 1 + k1 * r2 + k2 * r2 * r2
    return sample(img, u * k * f + w / 2, v * k * f + h / 2, np.zeros(1))


def resize(img: np.ndarray, width: int, height: int) -> np.ndarray:
    """Area means when shrinking, bilinear when growing."""
    h, w = img.shape[:2]
    src = img.reshape(h, w, -1)
    if width > w or height > h:
        y, x = np.mgrid[0:height, 0:width].astype(np.float64)
        return sample(img, (x + 0.5) * w / width - 0.5, (y + 0.5) * h / height - 0.5, src.reshape(-1, src.shape[2]).mean(axis=0))
    sums = np.pad(src.astype(np.float64).cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0), (0, 0)))
    ys, xs = np.arange(height + 1) * h // height, np.arange(width + 1) * w // width
    c = sums[ys][:, xs]
    area = np.diff(ys)[:, None, None] * np.diff(xs)[None, :, None]
    out = (c[1:, 1:] - c[:-1, 1:] - c[1:, :-1] + c[:-1, :-1]) / area
    return np.clip(np.rint(out), 0, 255).astype(np.uint8).reshape(height, width, *img.shape[2:])


def limited(img: np.ndarray, side: int) -> tuple[np.ndarray, float]:
    """The image with its longer side at most ``side``, and the scale."""
    h, w = img.shape[:2]
    k = min(1.0, side / max(h, w))
    return (img, 1.0) if k == 1 else (resize(img, max(1, int(w * k)), max(1, int(h * k))), k)


def trim(img: np.ndarray, fill: np.ndarray, distance: int = 30) -> tuple[np.ndarray, int, int]:
    """The bounding box of what differs from the fill color, and its offset; all of it where nothing does."""
    away = np.abs(img.reshape(*img.shape[:2], -1).astype(int) - fill).sum(axis=-1) > distance
    ys, xs = np.flatnonzero(away.any(axis=1)), np.flatnonzero(away.any(axis=0))
    if not len(ys):
        return img, 0, 0
    return img[ys[0] : ys[-1] + 1, xs[0] : xs[-1] + 1], int(xs[0]), int(ys[0])
