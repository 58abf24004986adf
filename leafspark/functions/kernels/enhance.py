"""Making a page easier to read: tone, noise, sharpness, flatness. Each function takes and gives an image."""

from __future__ import annotations

import numpy as np

from leafspark.functions.kernels import color, morph, page, warp


def white_balance(img: np.ndarray) -> np.ndarray:
    """Channel means brought to their common mean."""
    means = img.reshape(-1, 3).mean(axis=0)
    return np.clip(np.rint(img * (means.mean() / np.maximum(means, 1e-9))), 0, 255).astype(np.uint8)


def flat_background(img: np.ndarray, size: int = 101) -> np.ndarray:
    """Uneven light divided out: the local brightest mean becomes the page's."""
    g = color.gray(img).astype(float)
    light = np.maximum(morph.mean_blur(morph._slide(g, 15, 1, np.maximum, 0), size), 1)
    return np.clip(np.rint(img * (np.median(light) / light)[..., None]), 0, 255).astype(np.uint8)


def local_contrast(img: np.ndarray, tiles: int = 8, clip: float = 2.0) -> np.ndarray:
    """Histogram equalization by tiles, clipped, blended between tile centres; on brightness alone."""
    g = color.gray(img)
    h, w = g.shape
    ys, xs = np.linspace(0, h, tiles + 1).astype(int), np.linspace(0, w, tiles + 1).astype(int)
    maps = np.zeros((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            n = np.bincount(g[ys[i] : ys[i + 1], xs[j] : xs[j + 1]].ravel(), minlength=256).astype(float)
            top = max(clip * n.sum() / 256, 1)
            n = np.minimum(n, top) + np.maximum(n - top, 0).sum() / 256
            maps[i, j] = 255 * n.cumsum() / max(n.sum(), 1)
    y = np.clip((np.arange(h) + 0.5) * tiles / h - 0.5, 0, tiles - 1)
    x = np.clip((np.arange(w) + 0.5) * tiles / w - 0.5, 0, tiles - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None]
    at = lambda a, b: maps[a[:, None], b[None], g]
    new = (at(y0, x0) * (1 - fx) + at(y0, x1) * fx) * (1 - fy) + (at(y1, x0) * (1 - fx) + at(y1, x1) * fx) * fy
    return np.clip(np.rint(img * (new / np.maximum(g, 1))[..., None]), 0, 255).astype(np.uint8)


def denoise(img: np.ndarray, size: int = 3) -> np.ndarray:
    """Median of the surroundings, by channel."""
    r = size // 2
    p = np.pad(img, ((r, r), (r, r), (0, 0)), mode="edge")
    view = np.lib.stride_tricks.sliding_window_view(p, (size, size), axis=(0, 1))
    return np.median(view, axis=(-2, -1)).astype(np.uint8)


def sharpen(img: np.ndarray, amount: float = 0.7, sigma: float = 1.5) -> np.ndarray:
    return np.clip(np.rint(img + amount * (img - morph.gaussian(img, sigma))), 0, 255).astype(np.uint8)


def binarize(img: np.ndarray, size: int = 31, k: float = 0.2) -> np.ndarray:
    """Black where a pixel is below the local mean, less where the local spread is small."""
    g = color.gray(img).astype(float)
    mean = morph.mean_blur(g, size)
    spread = np.sqrt(np.maximum(morph.mean_blur(g * g, size) - mean * mean, 0))
    return np.where(g < mean * (1 + k * (spread / 128 - 1)), 0, 255).astype(np.uint8)


def saturate(img: np.ndarray, factor: float = 1.2) -> np.ndarray:
    g = color.gray(img).astype(float)[..., None]
    return np.clip(np.rint(g + factor * (img - g)), 0, 255).astype(np.uint8)


def without_stains(img: np.ndarray, ink: np.ndarray) -> np.ndarray:
    """Small brown spots outside the ink filled from around them."""
    h, s, v = color.hsv(img)
    spots = (h >= 5) & (h <= 25) & (s > 60) & (v < 180) & ~ink
    label, box = morph.components(spots)
    small = np.concatenate([[False], (box[:, 4] > 5) & (box[:, 4] < 200)])
    return morph.inpaint(img, morph.dilate(small[label], 3))


def dewarped(img: np.ndarray, **ink) -> np.ndarray:
    """Rows moved so that staff lines become straight; as it is with fewer than two lines."""
    lines = page.staff_lines(color.ink_mask(img, **ink))
    if len(lines) < 2:
        return img
    h, w = img.shape[:2]
    x = np.arange(w)
    at = np.array([line.y for line in lines])
    moved = np.array([np.polyval(line.coefficients, x) - line.y for line in lines])
    y = np.arange(h)
    k = np.clip(np.searchsorted(at, y) - 1, 0, len(at) - 2)
    f = np.clip((y - at[k]) / np.maximum(at[k + 1] - at[k], 1e-9), 0, 1)[:, None]
    shift = moved[k] * (1 - f) + moved[k + 1] * f
    return warp.sample(img, np.broadcast_to(x, (h, w)).astype(float), y[:, None] + shift, color.border_color(img))


#: Steps of ``enhanced``, in order.
STEPS = {
    "white_balance": white_balance, "flat_background": flat_background, "denoise": denoise, "local_contrast": local_contrast,
    "saturate": saturate, "sharpen": sharpen,
}


def enhanced(img: np.ndarray, steps: tuple[str, ...] = ("white_balance", "flat_background", "sharpen")) -> np.ndarray:
    for name in STEPS:
        if name in steps:
            img = STEPS[name](img)
    return img
