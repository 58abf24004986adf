"""Directly addressable codes: a token-id file in which any token is read without decoding a block.

An id is cut into chunks of 8 bits, the lowest first. Level k holds chunk k of every id that has one, and a
bitmap with a bit for each of its chunks: 1 where the id goes on at level k+1. The position there is the
number of ones before, which a rank directory (a count for every 512 bits) gives in constant time. Small,
frequent ids so take one byte, and ``Segment.token(i)`` reads one byte a level.

A file is a table of segments in ascending document order, written by Spark so that commits are atomic and
any store will do. A segment is self-contained: header, document table, levels.

Defined cases: a null text is empty and gives the end id alone; null ids come first; rows with one id are
ordered by their text's hash; an empty table gives an empty file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafspark.llm import store
from leafspark.llm.tokens import encoded

MAGIC = b"DAC1"
HEAD = struct.Struct("<4sIQBxxx")
LEVEL = struct.Struct("<QQQ")
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 19

SEGMENTS = "part int, seq long, first_token long, n_docs long, n_tokens long, payload binary"
_SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int64()),
        ("first_token", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def pack_levels(ids: np.ndarray) -> bytes:
    """Levels of chunks with continuation bitmaps and rank directories."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        rank = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        out += [LEVEL.pack(len(rest), len(bits), len(rank)), (rest & 0xFF).astype(np.uint8).tobytes()]
        out += [bits.tobytes(), rank.tobytes()]
        if not more.any():
            return b"".join(out)
        rest = rest[more] >> 8


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    keys = np.asarray([0 if d is None else d for d in doc_ids], dtype="<i8")
    null = np.asarray([d is None for d in doc_ids], dtype=np.uint8)
    sizes = np.asarray(lengths, dtype="<u8")
    head = HEAD.pack(MAGIC, len(keys), len(ids), 8)
    return b"".join([head, keys.tobytes(), null.tobytes(), sizes.tobytes(), pack_levels(ids)])


class Segment:
    """A view of a packed segment; nothing is decoded until asked for."""

    def __init__(self, payload: bytes):
        magic, n_docs, self.n_tokens, width = HEAD.unpack_from(payload, 0)
        if magic != MAGIC or width != 8:
            raise ValueError("not a segment of directly addressable codes")
        at = HEAD.size
        keys = np.frombuffer(payload, "<i8", n_docs, at)
        at += 8 * n_docs
        null = np.frombuffer(payload, np.uint8, n_docs, at)
        at += n_docs
        self.lengths = np.frombuffer(payload, "<u8", n_docs, at).astype(np.int64)
        at += 8 * n_docs
        self.doc_ids = [None if z else int(k) for k, z in zip(keys, null)]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.levels = []
        while at < len(payload):
            n, n_bits, n_rank = LEVEL.unpack_from(payload, at)
            at += LEVEL.size
            chunks = np.frombuffer(payload, np.uint8, n, at)
            bits = np.frombuffer(payload, np.uint8, n_bits, at + n)
            rank = np.frombuffer(payload, "<u4", n_rank, at + n + n_bits)
            at += n + n_bits + 4 * n_rank
            self.levels.append((chunks, bits, rank))

    def token(self, i: int) -> int:
        """Id number i, from one chunk a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, rank in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            lo = block * (RANK_BITS // 8)
            ones = int(rank[block]) + int(np.bitwise_count(bits[lo : i >> 3]).sum())
            i, shift = ones + int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count(), shift + 8
        return value

    def tokens(self) -> np.ndarray:
        """All ids."""
        out: np.ndarray | None = None
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if out is not None:
                high = np.zeros(len(chunks), dtype=np.uint32)
                high[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] = out
                value |= high << 8
            out = value
        return out if out is not None else np.zeros(0, np.uint32)

    def document(self, k: int) -> np.ndarray:
        return np.asarray([self.token(i) for i in range(self.starts[k], self.starts[k + 1])], dtype=np.uint32)


def _segments(
    rows: Iterable[tuple[int | None, bytes]], part: int, segment_tokens: int
) -> Iterator[pa.RecordBatch]:
    keys, sizes, kept, n, first, seq = [], [], [], 0, 0, 0

    def flush() -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(kept), dtype="<u4")
        row = [[part], [seq], [first], [len(keys)], [len(ids)], [pack_segment(keys, sizes, ids)]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _SEGMENTS.types)], schema=_SEGMENTS)

    for key, ids in rows:
        keys.append(key)
        sizes.append(len(ids) // 4)
        kept.append(ids)
        n += len(ids) // 4
        if n >= segment_tokens:
            yield flush()
            first, seq = first + n, seq + 1
            keys, sizes, kept, n = [], [], [], 0
    if keys:
        yield flush()


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    cut: str,
    end_id: int | None,
    key: str = "doc_id",
    text: str = "text",
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode whole texts in ascending key order and write them as segments."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("h"))
    rows = rows.repartitionByRange(store.shuffle_width(spark), "k", "h").sortWithinPartitions("k", "h")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from _segments(encoded(batches, tokenizer, cut, end_id), part, segment_tokens)

    rows.select("k", "t").mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit) from a file.

    Only one number a written partition comes to the driver.
    """
    table = spark.read.parquet(path)
    totals = dict(table.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, at = {}, 0
    for part in sorted(totals):
        before[part] = at
        at += totals[part]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, payload = (batch.column(c)[i].as_py() for c in ("part", "first_token", "payload"))
                seg = Segment(payload)
                ids, s = seg.tokens().astype("<u4", copy=False), seg.starts
                places = pa.py_buffer((4 * s).astype(np.int32))  # a segment is far below 2 GB but for one huge text
                if 4 * s[-1] < 1 << 31:
                    values = pa.Array.from_buffers(pa.binary(), len(s) - 1, [None, places, pa.py_buffer(ids)])
                else:
                    values = pa.array([ids[a:b].tobytes() for a, b in zip(s[:-1], s[1:])], pa.binary())
                start = pa.array(s[:-1] + (before[part] + first), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(seg.doc_ids, pa.int64()), start, values], names=["doc_id", "start", "ids"])

    return table.select("part", "first_token", "payload").mapInArrow(run, "doc_id long, start long, ids binary")
