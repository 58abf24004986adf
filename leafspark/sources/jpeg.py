"""Baseline JPEG files of images, on arrays: transform, quantization and entropy coding of all blocks at once.

Color is kept at full resolution. Entropy codes are made for each image from the counts of its own symbols, with
lengths from their shares, so no code table is built in.
"""

from __future__ import annotations

import struct

import numpy as np

# Quantization of brightness and of color at quality 50, row by row.
LUMA = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
CHROMA = (
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99,
)
#: Places of a block by anti-diagonals, every other one upwards.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i % 8 if (i // 8 + i % 8) % 2 == 0 else i // 8))))
_K = np.arange(8)
COSINES = np.where(_K[:, None] == 0, np.sqrt(0.125), 0.5 * np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16))
STRIP = 1 << 14


def _quantization(base: tuple[int, ...], quality: int) -> np.ndarray:
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(base) * scale + 50) // 100, 1, 255)


def _coefficients(plane: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Quantized coefficients of a plane's blocks, in zigzag order."""
    h, w = plane.shape
    padded = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge").astype(np.float32) - 128
    blocks = padded.reshape(padded.shape[0] // 8, 8, -1, 8).swapaxes(1, 2).reshape(-1, 8, 8)
    c = COSINES.astype(np.float32)
    out = (c @ blocks @ c.T).reshape(-1, 64) / table
    return np.rint(out).astype(np.int16)[:, ZIGZAG]


def _bits(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of bits of values, and the bits that tell a value of that many."""
    size = np.frexp(np.abs(v).astype(np.float64))[1].astype(np.int64)
    return size, np.where(v < 0, v + (1 << size) - 1, v)


def _symbols(z: np.ndarray, dc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of blocks in order: block, whether of the first coefficient, symbol, number of further bits, these bits."""
    n = len(z)
    dc_size, dc_bits = _bits(dc.astype(np.int64))
    block, k = np.nonzero(z[:, 1:])
    value = z[block, k + 1].astype(np.int64)
    before = np.where(np.concatenate([[True], block[1:] != block[:-1]]), -1, np.concatenate([[-1], k[:-1]])) if len(k) else k
    run = k - before - 1
    size, bits = _bits(value)
    long = np.repeat(np.arange(len(k)), run // 16)
    last = np.full(n, -1)
    last[block] = k
    open_ = np.flatnonzero(last < 62)
    zero = lambda m: np.zeros(m, dtype=np.int64)
    at = np.concatenate([np.arange(n) * 130, block[long] * 130 + 2 * k[long] + 2, block * 130 + 2 * k + 3, open_ * 130 + 129])
    order = np.argsort(at, kind="stable")
    symbol = np.concatenate([dc_size, zero(len(long)) + 0xF0, (run & 15) << 4 | size, zero(len(open_))])
    more = np.concatenate([dc_size, zero(len(long)), size, zero(len(open_))])
    tail = np.concatenate([dc_bits, zero(len(long)), bits, zero(len(open_))])
    return at[order] // 130, order < n, symbol[order], more[order], tail[order]


def _code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Codes and lengths of 256 symbols by their counts, and the table that describes them.

    A symbol's length is its share's, rounded up, 13 bits at most; one spare symbol keeps the code of all ones free.
    """
    used = np.flatnonzero(counts)
    share = np.maximum(np.append(counts[used], 1) / (counts.sum() + 1), 2.0**-12)
    length = np.maximum(np.ceil(-np.log2(share / share.sum())), 1).astype(int)[:-1]
    order = np.lexsort((used, length))
    codes, lengths, code, at = np.zeros(256, np.int64), np.zeros(256, np.int64), 0, 0
    for i in order:
        code <<= length[i] - at
        at = length[i]
        codes[used[i]], lengths[used[i]] = code, at
        code += 1
    per_length = np.bincount(length, minlength=17)[1:17].astype(np.uint8)
    return codes, lengths, per_length.tobytes() + used[order].astype(np.uint8).tobytes()


def _packed(value: np.ndarray, length: np.ndarray, rest: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Whole bytes of the bits of values, after what rest held, and what is left."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    down = np.repeat(ends, length) - 1 - np.arange(total)
    bits = np.concatenate([rest, (np.repeat(value, length) >> down & 1).astype(np.uint8)])
    cut = len(bits) // 8 * 8
    return np.packbits(bits[:cut]).tobytes(), bits[cut:]


def encode_jpeg(img: np.ndarray, quality: int = 90, dpi: int = 300) -> bytes:
    """File of an image (gray, or blue green red); quality is from 1 to 100."""
    if not 1 <= quality <= 100:
        raise ValueError("quality is from 1 to 100")
    h, w = img.shape[:2]
    tables = [_quantization(LUMA, quality), _quantization(CHROMA, quality)]
    if img.ndim == 3:
        b, g, r = (img[..., k].astype(np.float32) for k in range(3))
        y = 0.299 * r + 0.587 * g + 0.114 * b
        planes = [y, 128 + (b - y) / 1.772, 128 + (r - y) / 1.402]
    else:
        planes = [img]
    parts = [_coefficients(p, tables[min(k, 1)]) for k, p in enumerate(planes)]
    steps = [np.diff(p[:, 0].astype(np.int64), prepend=0) for p in parts]
    z, dc = np.stack(parts, axis=1).reshape(-1, 64), np.stack(steps, axis=1).reshape(-1)
    colors, counts, strips = len(parts), np.zeros((2, 2, 256), dtype=np.int64), []
    for lo in range(0, len(z), STRIP * colors):
        block, first, symbol, more, tail = _symbols(z[lo : lo + STRIP * colors], dc[lo : lo + STRIP * colors])
        kind = (block % colors > 0).astype(np.int64)
        np.add.at(counts, (kind, 1 - first.astype(np.int64), symbol), 1)
        strips.append((kind.astype(np.uint8), first, symbol.astype(np.uint8), more.astype(np.uint8), tail.astype(np.int16)))
    code = {(kind, ac): _code(counts[kind, ac]) for kind in range(min(colors, 2)) for ac in (0, 1)}
    body, rest = [], np.zeros(0, np.uint8)
    for kind, first, symbol, more, tail in strips:
        value, length = np.zeros(len(symbol), np.int64), np.zeros(len(symbol), np.int64)
        for (k, ac), (codes, lengths, _) in code.items():
            own = (kind == k) & (first == (ac == 0))
            value[own], length[own] = codes[symbol[own]], lengths[symbol[own]]
        made, rest = _packed(value << more | tail.astype(np.int64), length + more, rest)
        body.append(made)
    if len(rest):
        body.append(np.packbits(np.concatenate([rest, np.ones(8 - len(rest), np.uint8)])).tobytes())

    def segment(mark: int, data: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, mark, len(data) + 2) + data

    head = [b"\xff\xd8", segment(0xE0, struct.pack(">5sHBHHBB", b"JFIF\0", 0x0101, 1, dpi, dpi, 0, 0))]
    head += [segment(0xDB, bytes([k]) + tables[k][ZIGZAG].astype(np.uint8).tobytes()) for k in range(min(colors, 2))]
    shape = b"".join(bytes([k + 1, 0x11, min(k, 1)]) for k in range(colors))
    head.append(segment(0xC0, struct.pack(">BHHB", 8, h, w, colors) + shape))
    head += [segment(0xC4, bytes([ac << 4 | k]) + t) for (k, ac), (_, _, t) in code.items()]
    scan = b"".join(bytes([k + 1, min(k, 1) * 0x11]) for k in range(colors))
    head.append(segment(0xDA, bytes([colors]) + scan + b"\0\x3f\0"))
    return b"".join([*head, b"".join(body).replace(b"\xff", b"\xff\0"), b"\xff\xd9"])
