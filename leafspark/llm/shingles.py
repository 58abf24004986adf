"""Distinct word shingles of whole texts as 64-bit hashes, computed over many texts at once.

Words are maximal runs of bytes outside the six ASCII spaces, A-Z lower-cased. A word's hash is a polynomial
over its bytes, read as the difference of two prefix sums, so no word is touched by Python; a shingle's hash
mixes those of its words. A text with fewer words than a shingle has one shingle, its whole sequence; one
without words has none.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
CHUNK_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of 64."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a buffer that ends with a space."""
    space = _SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(raw)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum((_LOWER[raw].astype(U) + U(1)) * _powers(BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(BASE_INVERSE, n)[starts]
    return starts, mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < CHUNK_BYTES):
            size += len(texts[hi]) + 1
            hi += 1
        out += _sets(texts[lo:hi], width)
        lo = hi
    return out


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    at = np.cumsum([0, *[len(t) + 1 for t in texts]])
    starts, h = word_hashes(raw)
    first = np.searchsorted(starts, at)
    salts = mix(np.arange(1, width + 1, dtype=U))
    full = np.zeros(max(len(h) - width + 1, 0), dtype=U)
    for k in range(width):
        full += h[k : k + len(full)] * salts[k]
    full = mix(full + U(width))
    out = []
    for a, b in zip(first[:-1], first[1:]):
        n = b - a
        if n >= width:
            s = np.sort(full[a : b - width + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            short = (h[a:b] * salts[:n]).sum(dtype=U)
            out.append(mix(np.array([short + U(int(n) << 32)], dtype=U)))
        else:
            out.append(np.zeros(0, dtype=U))
    return out
