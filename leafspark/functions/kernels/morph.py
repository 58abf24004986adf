"""Morphology, components, blurs and thresholds, without an imaging library."""

from __future__ import annotations

import numpy as np


def _slide(x: np.ndarray, size: int, axis: int, pick: np.ufunc, pad: int) -> np.ndarray:
    """Running extreme of a window of the size, centred, by doubling."""
    if size <= 1:
        return x
    lo, hi = size // 2, size - 1 - size // 2
    widths = [(0, 0)] * x.ndim
    widths[axis] = (lo, hi)
    out = np.pad(x, widths, constant_values=pad)
    span, n = 1, x.shape[axis]
    take = lambda a, start, stop: np.take(a, np.arange(start, stop), axis=axis)
    while 2 * span <= size:
        m = out.shape[axis]
        out = pick(take(out, 0, m - span), take(out, span, m))
        span *= 2
    if span < size:
        m = out.shape[axis]
        out = pick(take(out, 0, m - (size - span)), take(out, size - span, m))
    return take(out, 0, n)


def dilate(mask: np.ndarray, width: int, height: int | None = None) -> np.ndarray:
    height = width if height is None else height
    x = _slide(mask.astype(np.uint8), width, 1, np.maximum, 0)
    return _slide(x, height, 0, np.maximum, 0).astype(bool)


def erode(mask: np.ndarray, width: int, height: int | None = None) -> np.ndarray:
    height = width if height is None else height
    x = _slide(mask.astype(np.uint8), width, 1, np.minimum, 1)
    return _slide(x, height, 0, np.minimum, 1).astype(bool)


def opened(mask: np.ndarray, width: int, height: int | None = None) -> np.ndarray:
    return dilate(erode(mask, width, height), width, height)


def closed(mask: np.ndarray, width: int, height: int | None = None) -> np.ndarray:
    return erode(dilate(mask, width, height), width, height)


def components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels (0 outside) and rows of x0, y0, x1, y1, area; eight neighbours, by merging runs of rows."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    y, a = np.nonzero(edge == 1)
    z = np.nonzero(edge == -1)[1]
    if not len(y):
        return np.zeros((h, w), np.int32), np.zeros((0, 5), int)
    parent = np.arange(len(y))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows = np.searchsorted(y, np.arange(h + 1))
    for r in range(1, h):
        i, j, i1, j1 = rows[r - 1], rows[r], rows[r], rows[r + 1]
        while i < i1 and j < j1:
            if a[i] <= z[j] and a[j] <= z[i]:
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
            if z[i] < z[j]:
                i += 1
            else:
                j += 1
    roots = np.array([find(i) for i in range(len(y))])
    _, label = np.unique(roots, return_inverse=True)
    n = label.max() + 1
    box = np.column_stack([np.full(n, w), np.full(n, h), np.zeros((n, 3), int)])
    np.minimum.at(box[:, 0], label, a)
    np.minimum.at(box[:, 1], label, y)
    np.maximum.at(box[:, 2], label, z)
    np.maximum.at(box[:, 3], label, y + 1)
    np.add.at(box[:, 4], label, z - a)
    out = np.zeros((h, w), np.int32)
    for r, s, e, k in zip(y, a, z, label):
        out[r, s:e] = k + 1
    return out, box


def box_sums(x: np.ndarray, size: int) -> np.ndarray:
    """Sum over a centred square, edges repeated."""
    lo = size // 2
    p = np.pad(x.astype(np.float64), ((lo + 1, size - 1 - lo), (lo + 1, size - 1 - lo)), mode="edge")
    c = p.cumsum(axis=0).cumsum(axis=1)
    return c[size:, size:] - c[:-size, size:] - c[size:, :-size] + c[:-size, :-size]


def mean_blur(x: np.ndarray, size: int) -> np.ndarray:
    return box_sums(x, size) / (size * size)


def gaussian(x: np.ndarray, sigma: float) -> np.ndarray:
    """Separable blur over six sigma, edges reflected."""
    r = max(1, int(3 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    out = x.astype(np.float64)
    for axis in (0, 1):
        widths = [(0, 0)] * out.ndim
        widths[axis] = (r, r)
        p = np.pad(out, widths, mode="reflect" if out.shape[axis] > r else "edge")
        n = out.shape[axis]
        out = sum(w * np.take(p, np.arange(i, i + n), axis=axis) for i, w in enumerate(k))
    return out


def otsu(gray: np.ndarray) -> int:
    """Threshold of greatest between-class variance, the least on ties."""
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    n0, s0 = n.cumsum(), (n * np.arange(256)).cumsum()
    n1, s1 = n0[-1] - n0, s0[-1] - s0
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((n0 > 0) & (n1 > 0), n0 * n1 * (s0 / n0 - s1 / n1) ** 2, -1)
    return int(np.argmax(score))


def adaptive_mask(gray: np.ndarray, size: int = 51, below: float = 10) -> np.ndarray:
    """Pixels darker than the mean of their surroundings."""
    return gray < mean_blur(gray, size) - below


def sobel(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.pad(gray.astype(np.float64), 1, mode="edge")
    row = p[:-2] + 2 * p[1:-1] + p[2:]
    col = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return row[:, 2:] - row[:, :-2], col[2:] - col[:-2]


def edges(gray: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Thin edges: gradient ridges over ``low`` in a component that reaches ``high``."""
    gx, gy = sobel(gaussian(gray, 1.0))
    size = np.hypot(gx, gy)
    p = np.pad(size, 1)
    flat = np.abs(gx) >= np.abs(gy)
    side = np.where(flat, np.maximum(p[1:-1, :-2], p[1:-1, 2:]), np.maximum(p[:-2, 1:-1], p[2:, 1:-1]))
    weak = (size >= low) & (size >= side)
    label, _ = components(weak)
    strong = np.unique(label[weak & (size >= high)])
    return weak & np.isin(label, strong[strong > 0])


def laplacian_variance(gray: np.ndarray, share: float = 1.0) -> float:
    """Population variance of the Laplacian, edges reflected, over the central share of the page."""
    h, w = gray.shape
    dy, dx = int(h * (1 - share) / 2), int(w * (1 - share) / 2)
    p = np.pad(gray[dy : h - dy, dx : w - dx].astype(np.float64), 1, mode="reflect")
    r = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    return float(r.var())


def inpaint(img: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Masked pixels filled ring by ring from the mean of their known neighbours."""
    out, left = img.astype(np.float64), mask.copy()
    while left.any():
        known = ~left
        p, k = np.pad(np.where(left[..., None], 0, out), ((1, 1), (1, 1), (0, 0))), np.pad(known, 1).astype(float)
        total, count = np.zeros_like(out), np.zeros(left.shape)
        for y in range(3):
            for x in range(3):
                total += p[y : y + left.shape[0], x : x + left.shape[1]]
                count += k[y : y + left.shape[0], x : x + left.shape[1]]
        ring = left & (count > 0)
        if not ring.any():
            break
        out[ring] = total[ring] / count[ring][:, None]
        left &= ~ring
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def hotspots(img: np.ndarray) -> np.ndarray:
    return dilate((img > 250).all(axis=-1), 5)


def stains(gray: np.ndarray) -> float:
    return float(np.abs(mean_blur(gray, 51) - mean_blur(gray, 151)).mean() / 255)


def foxing(img: np.ndarray, ink: np.ndarray) -> float:
    """Small round brown spots outside the ink, for 10,000 pixels."""
    from leafspark.functions.kernels.color import hsv

    h, s, v = hsv(img)
    _, box = components((h >= 5) & (h <= 25) & (s > 60) & (v < 180) & ~ink)
    w, t = box[:, 2] - box[:, 0], box[:, 3] - box[:, 1]
    round_ = np.maximum(w, t) < 3 * np.maximum(np.minimum(w, t), 1)
    return float(((box[:, 4] > 5) & (box[:, 4] < 200) & round_).sum() * 10_000 / ink.size)
