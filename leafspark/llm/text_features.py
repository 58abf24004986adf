"""Dense features of whole texts: shares of character classes, repetition and length, each at three scales."""

from __future__ import annotations

from operator import eq

import numpy as np

_CLASSES = (
    b"#*$%&|<>",
    b"!",
    bytes(range(65, 91)),
    bytes(range(97, 123)),
    b"0123456789",
    b" \t\n\x0b\x0c\r",
    b"\"'(),-./:;?@[]^_`{}~+=\\",
    bytes(range(128, 192)),
    bytes(range(192, 256)),
)
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _c in enumerate(_CLASSES):
    _TABLE[list(_c), _k] = 1
#: For each figure, the scales at which it is capped at 1.
SCALES = np.array(
    [
        [0.005, 0.02, 0.1],  # symbols
        [0.002, 0.01, 0.05],  # exclamation marks
        [0.05, 0.2, 0.6],  # capitals among letters
        [0.01, 0.05, 0.2],  # digits
        [0.03, 0.08, 0.2],  # share of spaces, away from the usual
        [0.02, 0.06, 0.2],  # punctuation
        [0.05, 0.2, 0.5],  # beyond ASCII
        [0.3, 0.6, 0.9],  # words seen before in the text
        [0.01, 0.1, 0.5],  # words equal to the one before
        [0.02, 0.2, 0.6],  # word triples seen before in the text
        [0.05, 0.3, 0.7],  # lines seen before in the text
        [1.0, 3.0, 10.0],  # mean word length, away from the usual
        [20.0, 50.0, 200.0],  # words
    ]
)
DIM = SCALES.size + 1


def _seen(items: list) -> float:
    return 1 - len(set(items)) / len(items) if items else 0.0


def features(text: str | None) -> np.ndarray:
    """DIM numbers in [0, 1], the last one 1; a null text is an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _TABLE
    chars = max(len(text), 1)
    words = text.split()
    count = len(words)
    figures = np.array(
        [
            n[0] / chars,
            n[1] / chars,
            n[2] / max(n[2] + n[3], 1),
            n[4] / chars,
            abs(n[5] / chars - 0.17),
            n[6] / chars,
            n[8] / chars,
            _seen(words),
            sum(map(eq, words, words[1:])) / max(count, 1),
            _seen(list(zip(words, words[1:], words[2:]))),
            _seen([line for line in text.split("\n") if line and not line.isspace()]),
            abs((chars - n[5]) / max(count, 1) - 5.5),
            count,
        ]
    )
    out = np.ones(DIM)
    out[:-1] = np.minimum(figures[:, None] / SCALES, 1).ravel()
    return out
