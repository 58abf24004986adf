"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: rotations learned by iterative quantization on a bounded sample (after principal directions, where
vectors are longer than codes) give 128 bits, the signs of the rotated, centred vector. A code is split into
two substrings of 64 bits. If two codes differ in at most r bits, then one substring differs in at most its
share of r - 1 bits (the pigeonhole principle for uneven shares). Each substring is found by four inverted
tables of 16 bits by the same principle: a table's lists of row numbers are probed at every value within the
piece's share. Codes that a substring finds are candidates; those within r in full are reranked by exact inner
products of the original vectors. The radius is learned too: the wanted quantile of code distances of sample
neighbours at the similarity that the k nearest of all rows will have. A query that finds fewer than k codes
within its radius widens it until it has k or all.

All rows are indexed, in blocks of bounded size. A block's vectors are sent once; all queries pass it as a
stream, so a task holds one block and one batch of queries, and gives k rows a query.

Defined cases: null, zero, or non-finite vectors take no part; vectors of different lengths have no inner product,
so each length is searched by itself; repeated rows are separate candidates, and only one row equal to a query in
id and vector is its own; ties go to the smaller id; with fewer than k other rows all are given; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafspark.llm import store

BITS = 128
WORD, PIECE = 64, 16
WORDS, PIECES = BITS // WORD, WORD // PIECE
WIDEN = 8
_ORDER = np.argsort(np.bitwise_count(np.arange(1 << PIECE, dtype=np.uint16)), kind="stable")
#: All differences of a piece, those with fewer bits first, and how many have at most 0, 1, .. bits.
MASKS = _ORDER.astype(np.uint16)
WITHIN = np.cumsum(np.bincount(np.bitwise_count(MASKS), minlength=PIECE + 1))


def shares(radius: int, parts: int) -> list[int]:
    """Bits that each part may differ in, so that codes within the radius agree with one part's share at least."""
    base, extra = divmod(radius - parts + 1, parts)
    return [base + 1] * extra + [base] * (parts - extra)


@dataclass
class Codes:
    """Centre, directions (a column a bit) and radius; encode() gives rows of two 64-bit words."""

    mean: np.ndarray
    directions: np.ndarray
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.directions > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(len(x), WORDS)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of every code of a to every one of b."""
    return sum(np.bitwise_count(a[:, k, None] ^ b[None, :, k]).astype(np.int64) for k in range(WORDS))


def fit(sample: np.ndarray, rows: int, k: int, recall: float, rounds: int = 30, seed: int = 7) -> Codes:
    """Rotations and radius from a sample of a table of so many rows."""
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    mean = sample.mean(axis=0)
    x = sample - mean
    basis = np.eye(dim)
    if dim > BITS:
        basis = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :BITS]
    x, width = x @ basis, min(dim, BITS)
    rotations = []
    for _ in range(-(-BITS // width)):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(x @ r).T @ x)
            r = (u @ v).T
        rotations.append(basis @ r)
    codes = Codes(mean, np.concatenate(rotations, axis=1)[:, :BITS], 0)
    some = sample[: min(len(sample), 512)]
    near = max(1, min(len(sample) - 1, round(k * len(sample) / max(rows, 1))))
    sims = some @ sample.T
    sims[np.arange(len(some)), np.arange(len(some))] = -np.inf
    top = np.argpartition(-sims, near - 1, axis=1)[:, :near]
    ham = np.take_along_axis(distances(codes.encode(some), codes.encode(sample)), top, axis=1)
    codes.radius = int(np.quantile(ham, recall, method="higher"))
    return codes


class Table:
    """Inverted lists of one piece: row numbers by value."""

    def __init__(self, pieces: np.ndarray):
        self.rows = np.argsort(pieces, kind="stable").astype(np.int32)
        counts = np.bincount(pieces, minlength=1 << PIECE)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.values = np.flatnonzero(counts).astype(np.uint16)

    def probe(self, value: np.uint16, share: int) -> np.ndarray:
        """Rows whose value differs from this one in at most ``share`` bits."""
        if share < 0:
            return self.rows[:0]
        near = WITHIN[min(share, PIECE)]
        if near < len(self.values):  # look up every value near this one, or leave out those that are not
            probed = MASKS[:near] ^ value
        else:
            probed = self.values[np.bitwise_count(self.values ^ value) <= share]
        probed = probed.astype(np.int64)
        lo = self.first[probed]
        size = self.first[probed + 1] - lo
        ends = np.cumsum(size)
        return self.rows[np.repeat(lo - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


@dataclass
class Index:
    """Inverted tables of a block's codes; counts what its queries probed, found and reranked."""

    codes: np.ndarray
    tables: list[list[Table]] = field(default_factory=list)
    queries: int = 0
    probed: int = 0
    candidates: int = 0
    reranked: int = 0

    def __post_init__(self) -> None:
        pieces = np.ascontiguousarray(self.codes).view("<u2").reshape(len(self.codes), WORDS * PIECES)
        self.tables = [[Table(pieces[:, PIECES * w + i]) for i in range(PIECES)] for w in range(WORDS)]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of all rows whose code is within the radius of a query's."""
        if radius >= BITS:
            return np.arange(len(self.codes))
        found = np.zeros(len(self.codes), dtype=bool)
        pieces = query.view("<u2")
        for w, share in enumerate(shares(radius, WORDS)):
            for i, own in enumerate(shares(share, PIECES)):
                rows = self.tables[w][i].probe(pieces[PIECES * w + i], own)
                self.probed += len(rows)
                found[rows[np.bitwise_count(self.codes[rows, w] ^ query[w]) <= share]] = True
        rows = np.flatnonzero(found)
        full = np.bitwise_count(self.codes[rows] ^ query).sum(axis=1, dtype=np.int64)
        self.candidates += len(rows)
        return rows[full <= radius]

    def nearest(
        self, ids: np.ndarray, vectors: np.ndarray, q_id: int, q: np.ndarray, q_code: np.ndarray, k: int, radius: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but one that equals the query, best first."""
        same = np.flatnonzero(ids == q_id)
        same = same[(vectors[same] == q).all(axis=1)][:1]
        wanted = min(k, len(ids) - len(same))
        while True:
            rows = self.within(q_code, radius)
            rows = rows[~np.isin(rows, same)] if len(same) else rows
            if len(rows) >= wanted:
                break
            radius = min(BITS, radius + WIDEN)
        self.queries, self.reranked = self.queries + 1, self.reranked + len(rows)
        score = vectors[rows] @ q
        if len(rows) > k:
            best = score >= np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[best], score[best]
        best = np.lexsort((ids[rows], -score))[:k]
        return ids[rows][best], score[best]


def _floats(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8")


def _blocks(batches: Iterable[pa.RecordBatch], dim: int, k: int, radius: int) -> Iterator[pa.RecordBatch]:
    """Rows of block, kind (0: indexed, 1: query), uid, id, code and v, in this order; each block's k best a query."""
    block, held, index = None, [], None

    def arrays(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer(b"".join(b.column("code").to_pylist()), "<u8").reshape(-1, WORDS)
        return b.column("uid").to_numpy(), b.column("id").to_numpy(), codes, _floats(b.column("v")).reshape(-1, dim)

    for b in batches:
        at, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(at) != 0) | (np.diff(kinds) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, b.num_rows]):
            if lo == hi:
                continue
            if at[lo] != block:
                block, held, index = at[lo], [], None
            part = arrays(b.slice(lo, hi - lo))
            if kinds[lo] == 0:
                held.append(part)
                continue
            if not held:
                continue
            if index is None:
                _, ids, codes, vectors = (np.concatenate(c) for c in zip(*held))
                held = [(ids, vectors)]
                index = Index(codes)
            ids, vectors = held[0]
            out = [index.nearest(ids, vectors, i, v, c, k, radius) for _, i, c, v in zip(*part)]
            sizes = [len(x) for x, _ in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part[0], sizes)), pa.array(np.repeat(part[1], sizes)), pa.array(np.concatenate([x for x, _ in out])),
                 pa.array(np.concatenate([s for _, s in out]))],
                names=["uid", "query_id", "vec_id", "score"],
            )


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(ok)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.94, key: str = "vec_id",
    vector: str = "embedding", sample_rows: int = 4096, block_rows: int = 1 << 16,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest by inner product, its own row left out.

    ``queries`` holds rows of the same form. Codes and radius are learned from about ``sample_rows``.
    """
    spark = vectors.sparkSession
    with store.scratch(spark):
        rows, asked = store.cut(usable(vectors, key, vector), "vectors"), store.cut(usable(queries, key, vector), "queries")
        found = None
        for size in sorted(rows.groupBy(F.size("v").alias("d")).count().collect()):
            right = F.size("v") == size["d"]
            one = _search(rows.filter(right), asked.filter(right), size["d"], size["count"], k, recall, sample_rows, block_rows)
            found = one if found is None else found.unionByName(one)
        if found is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        order = Window.partitionBy("dim", "uid").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return store.cut(ranked.select("query_id", "rank", "vec_id", "score"), "nearest", keep=True)


def _search(
    rows: DataFrame, asked: DataFrame, dim: int, count: int, k: int, recall: float, sample_rows: int, block_rows: int
) -> DataFrame:
    """dim, uid (of the query's row), query_id, vec_id and score: k rows a query and block."""
    spark = rows.sparkSession
    picked = store.bounded_sample(rows, "id", sample_rows, count).orderBy("id", "v")
    codes = fit(np.asarray([r["v"] for r in picked.select("v").collect()]), count, k, recall)
    blocks = max(-(-count // block_rows), min(store.shuffle_width(spark), -(-count // 8192)))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype("<f8")
            made = codes.encode(x) if len(x) else []
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("id"), pa.array([c.tobytes() for c in made], pa.binary()), pa.array([v.tobytes() for v in x], pa.binary())],
                names=["uid", "id", "code", "v"],
            )

    def coded(df: DataFrame, name: str) -> DataFrame:
        numbered = df.select(F.monotonically_increasing_id().alias("uid"), "id", "v")
        return store.cut(numbered.mapInArrow(store.tidy(index), "uid long, id long, code binary, v binary"), name)

    home = F.pmod(F.xxhash64("id"), F.lit(blocks))  # rows of one id lie in one block
    indexed = coded(rows, "codes").select(home.alias("block"), F.lit(0).alias("kind"), "uid", "id", "code", "v")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    passing = coded(asked, "asked").select(every.alias("block"), F.lit(1).alias("kind"), "uid", "id", "code", "v")
    stream = indexed.unionByName(passing).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    radius = codes.radius
    near = stream.mapInArrow(
        store.tidy(lambda b: _blocks(b, dim, k, radius)), "uid long, query_id long, vec_id long, score double"
    )
    return near.select(F.lit(dim).alias("dim"), "uid", "query_id", "vec_id", "score")
