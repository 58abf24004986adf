"""Sequence packing by non-negative least squares over a histogram of piece lengths.

Texts become token pieces: whole windows, and one tail of fewer tokens. Tail lengths fall into bins of
``grain`` tokens. All combinations of up to ``depth`` bins that fill a window exactly are the patterns;
Lawson-Hanson finds nonnegative repeat counts whose used pieces are nearest to the histogram; counts are
rounded down, repaired where bins would be overdrawn, and what is left is packed greedily, again as patterns
with counts. The driver sees only the histogram, whose size is the number of bins.

Pieces get ranks inside their bin from counts of (partition of the row id, bin), so no bin meets in one
task, however hot. Rank ranges map to (pattern, slot, sequence) by binary search in a table of the patterns'
size. Token ids are written once and never shuffled for the placement.

Defined cases: null and empty texts give the end id alone; repeated rows are separate documents, as each row
gets an id of its own; ties in a bin go by row id; an empty table gives no piece; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafspark.llm import store
from leafspark.llm.tokens import CACHE_WORDS, encoded

TOKENS = "row long, doc_id long, doc_tokens long, ids binary"


def tokenized(
    docs: DataFrame, tokenizer: str, cut: str, end_id: int | None, key: str = "doc_id", text: str = "text", cache_words: int = CACHE_WORDS
) -> DataFrame:
    """Written table of row (unique), doc_id, doc_tokens and ids; a worker holds about cache_words words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        out: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["row", "doc_id", "doc_tokens", "ids"])

        for k, ids in encoded(batches, tokenizer, cut, end_id, cache_words):
            out.append((row, k, len(ids) // 4, ids))
            row, size = row + 1, size + len(ids)
            if size > 4 << 20:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return store.cut(rows.mapInArrow(run, TOKENS), "tokens", codec="zstd")


def patterns(bins: int, depth: int) -> np.ndarray:
    """Rows of up to depth bins, ascending and padded with 0, whose sum is the window."""
    rows = [np.array([[bins] + [0] * (depth - 1)], dtype=np.int64)]

    def grow(prefix: np.ndarray, left: np.ndarray, k: int) -> None:
        """prefix: n x (k-1) ascending parts; left: what they lack; closes them with a last part."""
        last = prefix[:, -1]
        ok = left >= last
        closed = np.column_stack([prefix[ok], left[ok]])
        rows.append(np.pad(closed, ((0, 0), (0, depth - k))))
        if k < depth:
            counts = np.maximum(left // 2 - last + 1, 0)  # the next part leaves as much for the one after
            at = np.repeat(np.arange(len(last)), counts)
            step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            part = last[at] + step
            grow(np.column_stack([prefix[at], part]), left[at] - part, k + 1)

    if depth > 1:
        first = np.arange(1, bins // 2 + 1)[:, None]
        grow(first, bins - first[:, 0], 2)
    return np.concatenate(rows)


def nnls(pats: np.ndarray, hist: np.ndarray, steps: int = 400) -> np.ndarray:
    """Lawson-Hanson for min |A x - hist|, x >= 0; column j of A counts the bins of pattern j."""
    n = len(hist) - 1
    x, passive, resid = np.zeros(len(pats)), [], hist.astype(float).copy()
    column = np.zeros((n + 1, 0))
    scale = max(hist.max(), 1)

    for _ in range(steps):
        resid[0] = 0
        gain = resid[pats].sum(axis=1)
        gain[passive] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-6 * scale:
            break
        new = np.bincount(pats[j], minlength=n + 1).astype(float)
        new[0] = 0
        passive.append(j)
        column = np.column_stack([column, new])
        while passive:
            gram = column.T @ column
            z = np.linalg.solve(gram + 1e-9 * np.eye(len(passive)), column.T @ hist)
            if z.min() > 0:
                break
            now = x[passive]
            bad = z <= 0
            step = np.min(now[bad] / np.maximum(now[bad] - z[bad], 1e-12))
            x[passive] = now + step * (z - now)
            keep = x[passive] > 1e-9
            x[[p for p, k in zip(passive, keep) if not k]] = 0
            column = column[:, keep]
            passive = [p for p, k in zip(passive, keep) if k]
        else:
            z = np.zeros(0)
        x[:] = 0
        x[passive] = z
        resid = hist - column @ z
    return x


@dataclass
class Plan:
    """Patterns as lists of bins (largest first) and how often each is used."""

    bins: list[list[int]]
    counts: list[int]


def plan(hist: np.ndarray, depth: int) -> Plan:
    """hist[b]: pieces of bin b, b from 1 to the number of bins in a window."""
    n, left = len(hist) - 1, hist.astype(np.int64).copy()
    pats = patterns(n, depth)
    pats = pats[((pats == 0) | (hist[pats] > 0)).all(axis=1)]
    out = Plan([], [])

    def take(bins: list[int], times: int) -> None:
        used = np.bincount(bins, minlength=n + 1)
        need = used > 0
        times = int(min(times, (left[need] // used[need]).min()))
        if times > 0:
            left[:] = left - times * used
            out.bins.append(sorted(bins, reverse=True))
            out.counts.append(times)

    if len(pats) and hist.sum():
        x = nnls(pats, hist.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            take([int(b) for b in pats[j] if b], int(x[j]))
    while left[1:].any():  # greedy: the largest that is left, filled with the largest that fit
        room, bins, rest = n, [], left.copy()
        while room:
            fits = np.flatnonzero(rest[1 : room + 1]) + 1
            if not len(fits):
                break
            b = int(fits[-1])
            k = int(min(room // b, rest[b]))
            bins += [b] * k
            rest[b] -= k
            room -= b * k
        take(bins, int(left.max()))
    return out


def _spans(made: Plan, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rank ranges of bins: key (bin << 44 | first rank), first rank, first sequence, slot."""
    used = np.zeros(bins + 1, dtype=np.int64)
    rows, sequence = [], 0
    for pattern, times in zip(made.bins, made.counts):
        for slot, b in enumerate(pattern):
            rows.append((b, int(used[b]), sequence, slot))
            used[b] += times
        sequence += times
    rows.sort()
    b, lo, seq, slot = (np.asarray(c, dtype=np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 4
    return (b << 44) | lo, lo, seq, slot


@dataclass
class Packed:
    """pieces: row, doc_id, start, length, doc_tokens, ids. places: row, start, sequence_id, offset."""

    pieces: DataFrame
    places: DataFrame
    plan: Plan

    def sequences(self) -> DataFrame:
        """Pieces with their ids and places."""
        return self.pieces.join(self.places, ["row", "start"]).drop("row")


def pack(tokens: DataFrame, window: int = 4096, grain: int = 8, depth: int = 3) -> Packed:
    """Pack the table of ``tokenized`` into sequences of at most ``window`` tokens."""
    spark, bins = tokens.sparkSession, window // grain
    if window % grain:
        raise ValueError("grain divides window")
    parts = 8 * store.shuffle_width(spark)
    cuts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(window).cast("long")))
    some = F.col("doc_tokens") > 0

    def lengths(df: DataFrame, *cols: str) -> DataFrame:
        return df.filter(some).select("row", "doc_tokens", *cols, cuts.alias("start")).withColumn(
            "length", F.least(F.lit(window).cast("long"), F.col("doc_tokens") - F.col("start"))
        )

    pieces = lengths(tokens, "doc_id", "ids").withColumn(
        "ids", F.substring("ids", (4 * F.col("start") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    )
    small = lengths(tokens).select(
        "row", "start", "length",
        F.ceil(F.col("length") / grain).cast("int").alias("bin"),
        F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"),
    )
    counts = store.cut(small.groupBy("part", "bin").agg(F.count("*").alias("n")), "lengths")
    hist = np.zeros(bins + 1, dtype=np.int64)
    for b, n in counts.groupBy("bin").agg(F.sum("n")).collect():
        hist[b] = n
    made = plan(hist, depth)
    keys, lo, seq, slot = _spans(made, bins)

    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    offsets = store.cut(offsets, "ranks")
    inside = Window.partitionBy("part", "bin").orderBy("row", "start")
    ranked = (
        small.repartition("part")
        .withColumn("at", F.row_number().over(inside))
        .join(offsets, ["part", "bin"])
        .select("row", "start", "length", "bin", (F.col("before") + F.col("at") - 1).alias("rank"))
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bin_, rank = (b.column(c).to_numpy().astype(np.int64) for c in ("bin", "rank"))
            k = np.searchsorted(keys, (bin_ << 44) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("start"), b.column("length"), pa.array(seq[k] + rank - lo[k]), pa.array(slot[k])],
                names=["row", "start", "length", "sequence_id", "slot"],
            )

    placed = ranked.mapInArrow(place, "row long, start long, length long, sequence_id long, slot long")
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    places = placed.select(
        "row", "start", "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    )
    return Packed(pieces, places, made)


def padding(lengths: Iterable[int], window: int = 4096) -> int:
    """Tokens of padding: a sequence is padded to the window unless its length is a power of two."""
    return sum(0 if n & (n - 1) == 0 else window - n for n in lengths)
