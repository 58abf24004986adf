"""Near-duplicates by MinHash bands, odd sketches and a final check on full shingle sets.

1. A text's distinct shingles give a fingerprint of the set, MinHash samples, a 64-bit key for each band of
   samples, and an odd sketch: 512 parity bits, one flipped for each (place, sample). The exclusive or of
   two sketches counts the samples in which they differ.
2. Texts of one set are one class, known by its least id; later steps see classes only.
3. Classes that share a band key are candidates. In a bucket, all are compared with its least member, not
   with each other. Candidates whose sketches tell a similarity far below the threshold go; the rest are
   checked on full sets, in integers.
4. Links found are contracted; members of a bucket that still lie in different parts are compared with the
   bucket's next member, and after ``STARS`` such rounds with each other: in small buckets
   as pairs, sketches first; larger ones are cut into blocks, each two of which meet in a task that
   intersects full sets as bitmaps and gives links alone, so pairs are never written out.
   Pairs inside a part need no check: it could not change the components. Those are settled once, at the end.

Full sets are sets of 64-bit hashes of shingles. A text pair is misjudged only where hashes of different shingles
of the two collide: for two texts of 10,000 shingles the chance is under 1e-11.

Band sizes are chosen so that a pair at the threshold misses all buckets with a chance under 1e-5, and the
sketch limit is five standard deviations or more over what such a pair has.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; repeated rows are
in one component; rows of one id count as one document; rows without an id are linked with nothing and
kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store
from leafspark.llm.components import components, contracted
from leafspark.llm.shingles import U, mix, shingle_sets

BANDS = 32
SKETCH_BITS = 512
SKETCH_MARGIN = 0.15
SKETCH_DEVIATIONS = 5
STARS = 3
SMALL_BUCKET = 24
BLOCK = 256


@dataclass(frozen=True)
class Similarity:
    """Words in a shingle, and the least Jaccard similarity as a fraction over 100."""

    width: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Samples in a band: the most with which a pair at the threshold is still found."""
        t, r = self.percent / 100, 1
        while (1 - t ** (r + 1)) ** BANDS < 1e-5:
            r += 1
        return r

    @property
    def samples(self) -> int:
        return BANDS * self.rows


class MinHash:
    def __init__(self, like: Similarity, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.rows, k = like.rows, like.samples
        self.a = rng.integers(0, 1 << 32, k, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, k, dtype=np.uint32)
        self.place = mix(np.arange(1, k + 1, dtype=U))
        self.band = mix(np.arange(1001, 1001 + BANDS, dtype=U))

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        x = (hashes >> U(32)).astype(np.uint32)
        out = np.full(len(self.a), np.uint32(0xFFFFFFFF))
        for lo in range(0, len(x), 256):
            part = x[lo : lo + 256]
            np.minimum(out, (part[:, None] * self.a + self.b).min(axis=0), out=out)
        return out

    def keys(self, samples: np.ndarray) -> np.ndarray:
        """A signed 64-bit key a band."""
        s = samples.astype(U).reshape(BANDS, self.rows)
        h = self.band.copy()
        for k in range(self.rows):
            h = mix(h ^ (s[:, k] + U(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)))
        return h.view(np.int64)

    def sketch(self, samples: np.ndarray) -> np.ndarray:
        """Parity bitmap as signed 64-bit words."""
        at = (mix(self.place ^ samples.astype(U)) % U(SKETCH_BITS)).astype(int)
        bits = np.bincount(at, minlength=SKETCH_BITS) & 1
        return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def sketch_limit(like: Similarity) -> int:
    """Most differing sketch bits of a pair that may reach the threshold.

    Those of a pair below it by the margin, and no fewer than lie within the deviations of a pair at it. Its
    samples differ by a binomial law, each one that does flips two bits, and bits that are odd differ.
    """
    t, n, bits = like.percent / 100, like.samples, SKETCH_BITS
    margin = bits / 2 * (1 - (1 - 2 / bits) ** (2 * n * (1 - (t - SKETCH_MARGIN))))
    even, both = ((t + (1 - t) * (1 - c / bits) ** 2) ** n for c in (2, 4))
    mean = bits / 2 * (1 - even)
    deviation = (mean + bits * (bits - 1) / 4 * (1 - 2 * even + both) - mean * mean) ** 0.5
    return int(np.ceil(max(margin, mean + SKETCH_DEVIATIONS * deviation)))


def _fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    x = mix(hashes ^ U(0xA0761D6478BD642F)).sum(dtype=U)
    y = mix(hashes * U(0xE7037ED1A0B428DB) + U(1)).sum(dtype=U)
    return tuple(int(v) for v in mix(np.array([x, y ^ U(len(hashes))], dtype=U)).view(np.int64))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("t").to_pylist()]


def signatures(rows: DataFrame, like: Similarity) -> DataFrame:
    """rows k, t: written table of doc_id, n_shingles, f1, f2, bands, sketch."""
    kinds = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())]
    schema = pa.schema([*kinds, ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(like)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                sets = shingle_sets(_texts(part), like.width)
                prints = [_fingerprint(s) for s in sets]
                samples = [hasher.samples(s) if len(s) else None for s in sets]
                cols = [
                    part.column("k"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                    pa.array([None if s is None else hasher.keys(s) for s in samples], schema.types[4]),
                    pa.array([None if s is None else hasher.sketch(s) for s in samples], schema.types[5]),
                ]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    made = rows.mapInArrow(store.tidy(run), "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sketch array<long>")
    return store.cut(made, "signatures")


def _full_sets(rows: DataFrame, like: Similarity) -> DataFrame:
    """rows k, t: node and its shingle hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                sets = [s.view(np.int64) for s in shingle_sets(_texts(part), like.width)]
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "s"])

    return rows.mapInArrow(store.tidy(run), "node long, s array<long>")


def _far(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH_BITS // 64)), F.lit(0))


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between rows of different labels and, where blocks differ, of different blocks."""
    node, label, side = (table.column(c).to_numpy() for c in ("node", "label", "side"))
    sets = table.column("s").combine_chunks()
    sizes = np.diff(sets.offsets.to_numpy())
    row = np.repeat(np.arange(len(node)), sizes)
    _, place, counts = np.unique(sets.flatten().to_numpy(), return_inverse=True, return_counts=True)
    common = counts > 1
    dense = np.cumsum(common) - 1
    keep = common[place]
    bits = np.zeros((len(node), -(-max(int(common.sum()), 1) // 64) * 64), dtype=bool)
    bits[row[keep], dense[place[keep]]] = True
    words = np.packbits(bits, axis=1).view("<u8")
    a, b = [], []
    two = side.min() != side.max()
    for i in range(len(node)):
        other = np.flatnonzero((label != label[i]) & ((side > side[i]) if two else (node > node[i])))
        if len(other):
            inter = np.bitwise_count(words[other] & words[i]).sum(axis=1, dtype=np.int64)
            hit = other[100 * inter >= percent * (sizes[other] + sizes[i] - inter)]
            a.append(np.full(len(hit), node[i]))
            b.append(node[hit])
    none = [np.zeros(0, np.int64)]
    return pa.table({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})


class _Linker:
    """Checks candidate pairs of classes and keeps the links."""

    def __init__(self, rows: DataFrame, classes: DataFrame, like: Similarity):
        self.rows, self.classes, self.like = rows, classes, like
        self.links: DataFrame | None = None

    def near(self, x: str, y: str) -> Column:
        """Whether sizes and sketches of two aliases allow the threshold."""
        n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        return (100 * F.least(n, m) >= self.like.percent * F.greatest(n, m)) & (
            _far(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")) <= sketch_limit(self.like)
        )

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """Pairs a, b that pass sizes and sketches."""
        c = self.classes.select("node", "n_shingles", "sketch")
        out = pairs.join(c.alias("x"), F.col("a") == F.col("x.node")).join(c.alias("y"), F.col("b") == F.col("y.node"))
        return out.filter(self.near("x", "y")).select("a", "b")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """node and s, the full shingle set, of nodes (a column k)."""
        nodes = store.cut(nodes.distinct(), "asked")
        own = self.rows.join(nodes, "k", "left_semi")
        sets = store.cut(_full_sets(own, self.like), "sets")
        if sets.count() > nodes.count():  # repeated rows
            one = sets.groupBy("node", F.xxhash64("s").alias("h")).agg(F.first("s").alias("s"))
            sets = store.cut(one.select("node", "s"), "sets")
        return sets

    def keep(self, links: DataFrame) -> None:
        links = store.cut(links, "links")
        self.links = links if self.links is None else self.links.unionByName(links)

    def check(self, pairs: DataFrame) -> None:
        """Confirm written pairs on full sets."""
        if pairs.isEmpty():
            return
        sets = self.sets(pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))))
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
        both = left.join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
        inter = F.size(F.array_intersect("x", "y")).cast("long")
        made = both.select("a", "b", inter.alias("i"), (F.size("x") + F.size("y")).cast("long").alias("n"))
        self.keep(made.filter(100 * F.col("i") >= self.like.percent * (F.col("n") - F.col("i"))).select("a", "b"))

    def check_blocks(self, members: DataFrame, sizes: DataFrame) -> None:
        """Find all links between labels in buckets (key, node, label) of sizes (key, n)."""
        if members.isEmpty():
            return
        sets = self.sets(members.select(F.col("node").alias("k")))
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        own = members.join(sizes, "key").select(
            "key", "node", "label", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int").alias("own")
        )
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        dealt = own.select("key", "node", "label", "own", other).select(
            "key", "node", "label", F.col("own").alias("side"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
        )
        met = dealt.join(sets, "node").groupBy("key", "i", "j")
        percent = self.like.percent
        self.keep(met.applyInArrow(lambda t: _block_links(t, percent), "a long, b long").distinct())

    def labels(self, settled: bool) -> DataFrame | None:
        """node and label of the links so far: components, or parts of them that one round finds."""
        return None if self.links is None else (components if settled else contracted)(self.links)


def grouped(docs: DataFrame, like: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs."""
    with store.scratch(docs.sparkSession):
        rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
        table = signatures(rows, like)
        some = table.filter("n_shingles > 0 and doc_id is not null")
        classes = store.cut(
            some.groupBy("f1", "f2").agg(
                F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
                F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
            ),
            "classes",
        )
        banded = classes.select("node", F.explode("bands").alias("key"))
        shared = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
        members = store.cut(banded.join(store.cut(shared, "keys"), "key", "left_semi"), "members")

        linker = _Linker(rows, classes, like)
        left = members.withColumn("label", F.col("node"))
        for _ in range(STARS):
            least = store.cut(left.groupBy("key").agg(F.min(F.struct("node", "label")).alias("c")), "centres")
            pairs = left.join(least, "key").filter("node != c.node and label != c.label")
            pairs = store.cut(pairs.select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
            linker.check(store.cut(linker.sketched(pairs), "near"))
            labels = linker.labels(settled=False)
            if labels is None:
                break
            # What has been compared with all of its bucket, and buckets of one component, are done.
            rest = left.join(least, "key").filter("node != c.node").select("key", "node")
            rest = rest.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
            rest = store.cut(rest, "members")
            split = rest.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
            left = store.cut(rest.join(store.cut(split.select("key"), "keys"), "key", "left_semi"), "members")
            if left.isEmpty():
                break
        if not left.isEmpty():
            sizes = store.cut(left.groupBy("key").agg(F.count("*").alias("n")), "sizes")
            few = left.join(sizes.filter(F.col("n") <= SMALL_BUCKET), "key", "left_semi")
            full = store.cut(few.join(classes.select("node", "n_shingles", "sketch"), "node"), "members")
            x, y = full.alias("x"), full.alias("y")
            apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label"))
            pairs = x.join(y, apart & linker.near("x", "y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
            linker.check(store.cut(pairs.distinct(), "near"))
            large = sizes.filter(F.col("n") > SMALL_BUCKET)
            linker.check_blocks(store.cut(left.join(large, "key", "left_semi"), "members"), large)
        labels = linker.labels(settled=True)

        out = some.select("doc_id", "n_shingles", "f1", "f2").join(classes.select("f1", "f2", "node"), ["f1", "f2"])
        if labels is None:
            out = out.withColumn("component_id", F.col("node"))
        else:
            out = out.join(labels, "node", "left").withColumn("component_id", F.coalesce("label", "node"))
        alone = table.filter("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
        names = ["doc_id", "n_shingles", "component_id"]
        out = out.select(names).unionByName(alone.select(names))
        out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return store.cut(out, "groups", keep=True)


def deduplicated(docs: DataFrame, like: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that a near-duplicate of smaller id stands for."""
    gone = store.cut(grouped(docs, like, key, text).filter("not kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, docs[f"`{key}`"].cast("long") == gone["doc_id"], "left_anti")
