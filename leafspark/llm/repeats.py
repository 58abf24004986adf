"""Repeats of at least ``length`` bytes across documents, from the interval tree of an enhanced suffix array.

A suffix array over a whole corpus is sparse here. Of each window of ``length`` bytes one 16-byte gram, the
least by a hash, is its anchor; equal windows have equal anchors at equal places, so every repeat shows among
the suffixes near anchors of one key.

1. Distinct texts are written once, bucketed by their hash; later joins with them move no text.
2. Anchors that two texts share are found from blobs of anchor keys, dealt by key.
3. Texts with shared anchors give each one's context: the bytes of the windows it stands for. Contexts that
   a task sees in several documents are settled there; the least document's goes on, once a task.
4. Contexts of a key meet. Suffixes at the windows' starts are sorted, neighbours' common prefixes scanned:
   each run with a common prefix of ``length`` bytes or more is a repeated window; its least document tells
   which occurrences go. Maximal repeats are no output: contexts end before longer ones do, and occurrences
   settled in step 3 are not kept. ``intervals`` finds them in a suffix array of whole texts; nothing here calls it.

What one key brings to a task is bounded by the number of tasks, not of occurrences.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` lose nothing; of equal texts
all but those of the least id go whole; rows without an id stay whole and give nothing; repeated rows of one
id get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store
from leafspark.llm.shingles import U, mix

GRAM = 16
CHUNK_BYTES = 1 << 19
FLUSH_ANCHORS = 1 << 19
FLUSH_TEXTS = 60_000
FLUSH_CONTEXTS = 1 << 14
KEY_BUCKET_BYTES = 16 << 20
BUCKET_BYTES = 4 << 20
MANY = 0xFFFF


@dataclass
class Anchors:
    """Per anchor: text (number in the chunk), key, place, and first and last window that it stands for."""

    text: np.ndarray
    key: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def anchors(raw: np.ndarray, ends: np.ndarray, length: int) -> Anchors:
    """Anchors of texts laid end to end; places count from the start of the buffer."""
    width, n = length - GRAM + 1, len(raw)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return Anchors(none, none.astype(U), none, none, none)
    words = np.ndarray((n - 7,), "<u8", raw, strides=(1,))
    grams = n - GRAM + 1
    h = mix(words[:grams] * U(0x9E3779B97F4A7C15) ^ mix(words[8 : 8 + grams]))
    least = (h & U(0xFFFFFFFF00000000)) | np.arange(grams, dtype=U)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    chosen = (least & U(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(chosen))
    text = np.searchsorted(ends, start, side="right")
    inside = start + length <= ends[text]
    start, chosen, text = start[inside], chosen[inside], text[inside]
    if not len(start):
        return Anchors(none, none.astype(U), none, none, none)
    first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([first[1:], [len(start)]]) - 1
    at = chosen[first]
    return Anchors(text[first], h[at], at, start[first], start[last])


def _chunks(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with their texts' bytes laid end to end, and where each ends."""
    for b in batches:
        column = b.column(text).cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], "<i8", len(column) + 1, 8 * column.offset)
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
            j = min(j, b.num_rows)
            yield b.slice(i, j - i), raw[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i]
            i = j


def _owners(b: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([b.column("t1").to_numpy(), b.column("t2").to_numpy()]).astype(np.int64).reshape(-1, 2)


BLOB = "flush string, bucket int, keys binary, owner binary, owners binary"
_BLOB = ["flush", "bucket", "keys", "owner", "owners"]
_BLOB_KINDS = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def _blobs(rows: list[tuple]) -> pa.Table:
    cols = zip(*rows) if rows else [[] for _ in _BLOB]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, _BLOB_KINDS)], names=_BLOB)


def _codes(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low half of keys: what is compared to tell shared anchors, contexts being exact."""
    return ((keys >> U(32)) % U(buckets)) << U(32) | keys & U(0xFFFFFFFF)


def _key_blobs(batches: Iterable[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per flush of texts: codes by bucket, each once; below bucket 0 its owners, and codes known to be shared.

    A flush is named by its first text, so a task that runs again gives the same names.
    """
    codes: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    held, texts = 0, 0

    def flush() -> Iterator[pa.RecordBatch]:
        k, o, ids = np.concatenate(codes), np.concatenate(owner), np.concatenate(owners)
        order = np.lexsort((o, k))
        k, o = k[order], o[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])  # a code once a text
        k, o = k[new], o[new].astype("<u2")
        first = np.concatenate([[True], k[1:] != k[:-1]])
        count = np.diff(np.concatenate([np.flatnonzero(first), [len(k)]]))
        shared = np.repeat(count > 1, count)
        name, low = f"{ids[0, 0]}:{ids[0, 1]}", -1 - int(ids[0, 0] % buckets)
        rows = [(name, low, k[shared].astype("<u8").tobytes(), o[shared].tobytes(), ids.tobytes())]
        sent, from_ = k[first], np.where(count > 1, MANY, o[first]).astype("<u2")
        cuts = np.searchsorted(sent >> U(32), np.arange(buckets + 1))
        for bucket in range(buckets):
            part = slice(cuts[bucket], cuts[bucket + 1])
            if part.start < part.stop:
                rows.append((name, bucket, (sent[part] & U(0xFFFFFFFF)).astype("<u4").tobytes(), from_[part].tobytes(), b""))
        yield from _blobs(rows).to_batches()

    for b, raw, ends in _chunks(batches):
        found = anchors(raw, ends, length)
        if len(found.key):
            codes.append(_codes(found.key, buckets))
            owner.append(found.text + texts)
            owners.append(_owners(b))
            held, texts = held + len(found.key), texts + b.num_rows
        if held >= FLUSH_ANCHORS or texts >= FLUSH_TEXTS:
            yield from flush()
            codes, owner, owners, held, texts = [], [], [], 0, 0
    if held:
        yield from flush()


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """Of a bucket's blobs: per flush, the codes that another flush, or several texts, have too."""
    bucket = key[0].as_py()
    if bucket < 0:
        return table.select(_BLOB)
    keys = [np.frombuffer(v, "<u4") for v in table.column("keys").to_pylist()]
    owner = [np.frombuffer(v, "<u2") for v in table.column("owner").to_pylist()]
    twice = np.concatenate([*keys, *[k[o == MANY] for k, o in zip(keys, owner)]])
    values, counts = np.unique(twice, return_counts=True)
    hot = values[counts > 1]
    rows = []
    for name, k, o in zip(table.column("flush").to_pylist(), keys, owner):
        mine = o != MANY
        if len(hot):
            mine = mine & (hot[np.minimum(np.searchsorted(hot, k), len(hot) - 1)] == k)
            if mine.any():
                code = k[mine].astype(U) | U(bucket) << U(32)
                rows.append((name, -1, code.astype("<u8").tobytes(), o[mine].tobytes(), b""))
    return _blobs(rows)


def _by_owner(table: pa.Table) -> pa.Table:
    """A flush's shared codes as rows of a text and its codes."""
    keys, owner, owners = (b"".join(table.column(c).to_pylist()) for c in ("keys", "owner", "owners"))
    k, o, ids = np.frombuffer(keys, "<u8"), np.frombuffer(owner, "<u2"), np.frombuffer(owners, "<i8").reshape(-1, 2)
    order = np.argsort(o, kind="stable")
    raw, o = k[order].tobytes(), o[order]
    used, first = np.unique(o, return_index=True)
    made = [raw[8 * x : 8 * y] for x, y in zip(first, [*first[1:], len(o)])]
    cols = [pa.array(ids[used, 0]), pa.array(ids[used, 1]), pa.array(made, pa.binary())]
    return pa.Table.from_arrays(cols, names=["t1", "t2", "keys"])


CONTEXTS = "bucket int, docs binary, owners binary, at binary, lo binary, hi binary, bytes binary"
_CONTEXTS = ["bucket", "docs", "owners", "at", "lo", "hi", "bytes"]
SPANS = "t1 long, t2 long, spans binary"


def _spans_of(owners: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Rows of a text and its spans (pairs of 64-bit numbers), of any number of spans."""
    order = np.lexsort((start, owners[:, 1], owners[:, 0]))
    o, pairs = owners[order], np.column_stack([start, end]).astype("<i8")[order]
    first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]).any(axis=1)])) if len(o) else np.zeros(0, int)
    cuts = np.concatenate([first, [len(o)]])
    made = [pairs[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(o[first, 0]), pa.array(o[first, 1]), pa.array(made, pa.binary())], names=["t1", "t2", "spans"]
    )


def _rows_of(matrix: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.shape[1]))).ravel()


def _context_blobs(
    batches: Iterable[pa.RecordBatch], length: int, key_buckets: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Contexts of shared anchors; below bucket 0 is what is settled here: texts and spans that go."""
    back = length - GRAM
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    kinds = (pa.int32(), *[pa.binary()] * 6)

    def flush() -> pa.RecordBatch:
        key, doc, own, at, lo, hi, ctx = (np.concatenate(c) for c in zip(*held))
        tail = np.column_stack([ctx, lo, hi]).astype(np.uint8)
        _, group = np.unique(_rows_of(tail), return_inverse=True)
        order = np.lexsort((at, doc, group))
        g = group[order]
        first = order[np.concatenate([[True], g[1:] != g[:-1]])]
        least = doc[first][group]
        gone = doc > least
        rows = []
        if gone.any():
            base = at[gone] - back
            rows.append((-1 - int(own[gone][0, 0] % buckets), b"", own[gone].tobytes(), (base + lo[gone]).astype("<i8").tobytes(), b"", b"",
                         (base + hi[gone] + length).astype("<i8").tobytes()))
        # One occurrence of each context goes on, and all of the least document, whose fate is open.
        keep = ~gone
        dealt = ((key >> U(32)) % U(buckets)).astype(np.int64)
        order = np.flatnonzero(keep)[np.argsort(dealt[keep], kind="stable")]
        cuts = np.searchsorted(dealt[order], np.arange(buckets + 1))
        for bucket in range(buckets):
            p = order[cuts[bucket] : cuts[bucket + 1]]
            if len(p):
                rows.append((bucket, doc[p].tobytes(), own[p].tobytes(), at[p].astype("<i8").tobytes(),
                             lo[p].astype(np.uint8).tobytes(), hi[p].astype(np.uint8).tobytes(), ctx[p].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_CONTEXTS)

    for b, raw, ends in _chunks(batches):
        found = anchors(raw, ends, length)
        lists = b.column("hot").to_pylist()
        hot = [np.frombuffer(b"".join(v), "<u8") for v in lists]
        key_text = np.repeat(np.arange(len(hot)), [len(h) for h in hot])
        salted = mix(np.concatenate(hot) ^ mix(key_text.astype(U) + U(1))) if len(hot) else np.zeros(0, U)
        mine = np.isin(mix(_codes(found.key, key_buckets) ^ mix(found.text.astype(U) + U(1))), salted)
        if not mine.any():
            continue
        starts = np.concatenate([[0], ends[:-1]])
        doc, own = b.column("doc").to_numpy(), _owners(b)
        for lo in range(0, int(mine.sum()), FLUSH_CONTEXTS):
            p = np.flatnonzero(mine)[lo : lo + FLUSH_CONTEXTS]
            text, at = found.text[p], found.at[p]
            places = at[:, None] + np.arange(-back - 1, length)[None, :]
            # The byte before, what precedes an anchor at most, and what follows it.
            ok = (places >= starts[text][:, None]) & (places < ends[text][:, None])
            ctx = np.where(ok, raw[np.clip(places, 0, len(raw) - 1)], 0).astype(np.uint8)
            held.append((found.key[p], doc[text], own[text], at - starts[text], found.lo[p] - at + back, found.hi[p] - at + back, ctx))
            n += len(p)
            if n >= FLUSH_CONTEXTS:
                yield flush()
                held, n = [], 0
    if n:
        yield flush()


def sorted_suffixes(ctx: np.ndarray, row: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of suffixes (row, at) of contexts, and each one's common prefix with the one before it.

    Compared are up to 8 * ceil(length / 8) bytes, as far as a context goes.
    """
    count = -(-length // 8)
    wide = np.pad(ctx, ((0, 0), (0, 8 * count)))
    view = np.lib.stride_tricks.sliding_window_view(wide, 8, axis=1)
    words = [view[row, at + 8 * j].view(">u8").ravel().astype(U) for j in range(count)]
    order = np.lexsort(words[::-1])
    lcp = np.full(max(len(row) - 1, 0), 8 * count, dtype=np.int64)
    open_ = np.ones(len(lcp), dtype=bool)
    for j in range(count):
        w = words[j][order]
        words[j] = w[:0]
        differ = w[1:] ^ w[:-1]
        here = open_ & (differ != 0)
        zeros = 63 - np.floor(np.log2(differ[here].astype(np.longdouble))).astype(np.int64)
        lcp[here] = 8 * j + zeros // 8
        open_ &= ~here
    left = ctx.shape[1] - at[order]
    lcp = np.minimum(lcp, np.minimum(left[1:], left[:-1]))
    return order, np.concatenate([[0], lcp])


def intervals(lcp: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, int, int, bool]]:
    """(common prefix, first, last, left-diverse) of every interval of common prefix ``least`` or more.

    One stack of open intervals; nested ones come before what encloses them. ``before`` has the byte before
    each suffix, or -1 at a text's start; an interval is left-diverse, and so a maximal repeat, if those differ.
    """
    stack: list[list] = []  # [common prefix, first, byte before or None where diverse]

    def join(x: int | None, y: int | None) -> int | None:
        return x if x == y and x != -1 else None

    n = len(lcp)
    for i in range(1, n + 1):
        height = int(lcp[i]) if i < n else 0
        first, seen = i - 1, int(before[i - 1])
        while stack and stack[-1][0] > height:
            depth, first, own = stack.pop()
            seen = join(own, seen)
            yield depth, first, i - 1, seen is None
        if height >= least:
            if stack and stack[-1][0] == height:
                stack[-1][2] = join(stack[-1][2], seen)
            else:
                stack.append([height, first, seen])
        else:
            stack.clear()


def _settle(key: tuple, table: pa.Table, length: int) -> pa.Table:
    """Spans that go, from a bucket's contexts."""
    if key[0].as_py() < 0:
        cols = zip(*(table.column(c).to_pylist() for c in ("owners", "at", "bytes")))
        own, start, end = (np.frombuffer(b"".join(c), "<i8") for c in zip(*cols))
        return pa.Table.from_batches([_spans_of(own.reshape(-1, 2), start, end)])
    back = length - GRAM
    joined = {c: b"".join(table.column(c).to_pylist()) for c in _CONTEXTS[1:]}
    doc, at = np.frombuffer(joined["docs"], "<i8"), np.frombuffer(joined["at"], "<i8")
    own = np.frombuffer(joined["owners"], "<i8").reshape(-1, 2)
    lo, hi = (np.frombuffer(joined[c], np.uint8).astype(np.int64) for c in ("lo", "hi"))
    ctx = np.frombuffer(joined["bytes"], np.uint8).reshape(len(doc), -1)
    tail = np.column_stack([ctx, lo, hi]).astype(np.uint8)
    _, some, group = np.unique(_rows_of(tail), return_index=True, return_inverse=True)
    least = np.full(len(some), np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc)
    counts = (hi - lo + 1)[some]
    row = np.repeat(np.arange(len(some)), counts)
    window = lo[some][row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    order, lcp = sorted_suffixes(ctx[some], row, window + 1, length)
    # The outermost intervals of the tree: runs of neighbours that share ``length`` bytes or more.
    first = np.flatnonzero(lcp < length)
    class_least = np.minimum.reduceat(least[row[order]], first) if len(first) else np.zeros(0, np.int64)
    by_window = np.full((len(some), back + 1), np.iinfo(np.int64).max)
    by_window[row[order], window[order]] = np.repeat(class_least, np.diff(np.concatenate([first, [len(lcp)]])))
    gone = by_window[group] < doc[:, None]
    edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    r, a = np.nonzero(edge == 1)
    _, z = np.nonzero(edge == -1)
    base = at[r] - back
    return pa.Table.from_batches([_spans_of(own[r], base + a, base + z - 1 + length)])


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes covered by spans (rows of start and end)."""
    if not len(spans):
        return spans.reshape(0, 2)
    s = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(s[:, 1])
    first = np.concatenate([[True], s[1:, 0] > reach[:-1]])
    cuts = np.flatnonzero(first)
    return np.column_stack([s[cuts, 0], reach[np.concatenate([cuts[1:], [len(s)]]) - 1]])


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 64):
            part = b.slice(i, 64)
            spans, kept = [], []
            for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
                runs = merged(np.frombuffer(b"".join(found or []), "<i8").reshape(-1, 2))
                at, out = 0, []
                for a, z in runs.tolist():
                    out.append(text[at:a])
                    at = z
                kept.append(b"".join([*out, text[at:]]) if out else text)
                spans.append([{"start": int(a), "end": int(z)} for a, z in runs])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            cols = [*(part.column(c) for c in ("t1", "t2", "doc")), pa.array([len(t) for t in part.column("text").to_pylist()], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(spans, kind), pa.array(kept, pa.binary())], names=["t1", "t2", "doc", "n_bytes", "spans", "kept"]
            )


@dataclass
class Removed:
    """rows: doc_id, t1, t2, n_bytes, sha (without an id). texts: t1, t2, doc (least id), n_bytes, spans, kept bytes.

    ``texts`` reads a bucketed table in the shared folder, which ``close`` forgets.
    """

    rows: DataFrame
    texts: DataFrame
    table: str

    def close(self) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


def removed(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> Removed:
    """Bytes of every document that repeat ``length`` bytes starting in a document of smaller id."""
    if length < GRAM + 1 or length > 120:
        raise ValueError(f"length is from {GRAM + 1} to 120")
    spark = docs.sparkSession
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    named = docs.select(F.col(key).cast("long").alias("doc_id"), raw.alias("text"))
    hashes = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
    size = F.octet_length("text").cast("long").alias("n_bytes")
    unnamed = F.when(F.col("doc_id").isNull(), F.sha2("text", 256)).alias("sha")
    rows = store.cut(named.select("doc_id", *hashes, size, unnamed), "rows")
    volume = rows.agg(F.sum("n_bytes")).collect()[0][0] or 0
    width = store.shuffle_width(spark)
    key_buckets = max(width, -(-volume // KEY_BUCKET_BYTES))
    buckets = max(width, -(-volume // BUCKET_BYTES))

    own = named.filter("doc_id is not null").select("doc_id", "text", *hashes)
    distinct = own.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc"), F.first("text").alias("text"))
    name = f"leafspark_texts_{uuid.uuid4().hex}"
    placed = distinct.write.option("path", store.own_path(spark, "texts")).option("compression", "zstd")
    placed.bucketBy(width, "t1", "t2").saveAsTable(name)
    del distinct
    store.release(spark)
    texts = spark.table(name)

    blobs = texts.select("t1", "t2", "text").mapInArrow(lambda b: _key_blobs(b, length, key_buckets), BLOB)
    met = store.cut(blobs.groupBy("bucket").applyInArrow(_shared, BLOB), "shared")
    hot = store.cut(met.groupBy("flush").applyInArrow(_by_owner, "t1 long, t2 long, keys binary"), "shared")
    del blobs
    store.release(spark)

    asked = hot.groupBy("t1", "t2").agg(F.collect_list("keys").alias("hot"))
    near = texts.join(asked.hint("merge"), ["t1", "t2"]).select("t1", "t2", "doc", "text", "hot")
    contexts = near.mapInArrow(lambda b: _context_blobs(b, length, key_buckets, buckets), CONTEXTS)
    spans = store.cut(contexts.groupBy("bucket").applyInArrow(lambda k, t: _settle(k, t, length), SPANS), "spans")
    del near, asked, contexts
    store.release(spark)

    found = spans.groupBy("t1", "t2").agg(F.collect_list("spans").alias("found"))
    both = texts.join(found.hint("merge"), ["t1", "t2"], "left").select("t1", "t2", "doc", "text", "found")
    kept = both.mapInArrow(
        _kept, "t1 long, t2 long, doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
    return Removed(rows, kept, name)


def digests(out: Removed, length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; texts stay where they are."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    each = out.texts.select(
        "t1", "t2", "doc", size.alias("gone"), F.size("spans").cast("long").alias("runs"), F.sha2("kept", 256).alias("sha")
    )
    each = store.cut(each, "digests")
    whole = out.rows.filter("doc_id is not null").drop("sha").join(each, ["t1", "t2"])
    copy = (F.col("doc_id") != F.col("doc")) & (F.col("n_bytes") >= length)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    made = whole.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.when(F.col("doc_id") == F.col("doc"), F.col("gone")).otherwise(0)).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.when(F.col("doc_id") == F.col("doc"), F.col("runs")).otherwise(0)).cast("long").alias("n_spans"),
        F.when(copy, empty).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    none = F.lit(0).cast("long")
    alone = out.rows.filter("doc_id is null").select(
        "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("sha").alias("kept_sha256")
    )
    return made.unionByName(alone)
