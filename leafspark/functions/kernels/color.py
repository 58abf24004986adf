"""Color spaces, ink masks and tonal measurements."""

from __future__ import annotations

import numpy as np


def gray(img: np.ndarray) -> np.ndarray:
    if img.ndim == 2:
        return img
    b, g, r = (img[..., k].astype(np.float32) for k in range(3))
    return np.clip(np.rint(0.114 * b + 0.587 * g + 0.299 * r), 0, 255).astype(np.uint8)


def hsv(img: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue in [0, 180), saturation and value in [0, 255]."""
    b, g, r = (img[..., k].astype(np.float32) for k in range(3))
    top, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    spread = top - low
    safe = np.where(spread == 0, 1, spread)
    hue = np.where(top == r, (g - b) / safe, np.where(top == g, 2 + (b - r) / safe, 4 + (r - g) / safe))
    hue = np.where(spread == 0, 0, np.mod(hue * 30, 180))
    return hue, np.where(top == 0, 0, 255 * spread / np.where(top == 0, 1, top)), top


def luma_chroma(img: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b, g, r = (img[..., k].astype(np.float32) for k in range(3))
    y = 0.299 * r + 0.587 * g + 0.114 * b
    return y, (r - y) * 0.713 + 128, (b - y) * 0.564 + 128


def hue_mask(img: np.ndarray, hue: float, reach: float, sat_min: float, val_min: float) -> np.ndarray:
    """Pixels of a hue, around the circle, that are saturated and bright enough."""
    h, s, v = hsv(img)
    away = np.abs(h - hue)
    return (np.minimum(away, 180 - away) <= reach) & (s >= sat_min) & (v >= val_min)


#: Channels (blue 0, green 1, red 2) that lead in each sixth of the hue circle of 180, from hue 0 on.
LEADING = ((2,), (2, 1), (1,), (1, 0), (0,), (0, 2))


def difference_mask(img: np.ndarray, hue: float, diff: float) -> np.ndarray:
    """Pixels whose leading channels exceed the others by the difference; for inks too pale for a hue."""
    lead = LEADING[int((hue + 15) % 180 // 30)]
    x = img.astype(np.int16)
    rest = [k for k in range(3) if k not in lead]
    return x[..., list(lead)].min(axis=-1) - x[..., rest].max(axis=-1) >= diff


def ink_mask(img: np.ndarray, hue: float = 5, reach: float = 15, sat_min: float = 40, val_min: float = 80, diff: float = 30) -> np.ndarray:
    """Ink by hue, or by channel differences where the hue finds under 0.05 % of the page."""
    if img.ndim == 2:
        return np.zeros(img.shape, bool)
    found = hue_mask(img, hue, reach, sat_min, val_min)
    return found if found.mean() >= 0.0005 else difference_mask(img, hue, diff)


def border_color(img: np.ndarray, share: float = 0.05) -> np.ndarray:
    """Median color of the strips along the four edges, corners once."""
    h, w = img.shape[:2]
    y, x = max(1, int(h * share)), max(1, int(w * share))
    edge = np.ones((h, w), bool)
    edge[y : h - y, x : w - x] = False
    return np.median(img[edge].reshape(-1, *img.shape[2:]), axis=0).astype(int)


def gray_world_deviation(img: np.ndarray) -> float:
    means = img.reshape(-1, 3).mean(axis=0)
    return float(np.abs(means - means.mean()).max())


def fading(img: np.ndarray) -> float:
    """How far the mean saturation of colored pixels is below 80."""
    s = hsv(img)[1]
    colored = s[s > 20]
    return 0.0 if colored.size < 100 else float(max(0.0, (80 - colored.mean()) / 80))


def dark_share(img: np.ndarray, limit: int = 80) -> float:
    return float((gray(img) < limit).mean())
