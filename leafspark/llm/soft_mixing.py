"""Mixing to target weights with soft domain membership.

A softmax classifier, learned from a labelled table, gives every document posteriors p over domains. Rates
r then minimize the squared distance between expected domain tokens, sum of r * tokens * p, and their
targets, starting from rate 1: projected gradient over all documents. The gradient at a document is its p
times the misses; each step is scaled by the token-weighted second moments of the documents that can still
move, and halved while it does not bring the totals nearer. A step needs only as many sums as there are
domains and their pairs; a document's rate is refolded from the list of the steps so far, so no state is
kept a document. The fit ends when all totals lie within the tolerance of their targets, or where no step
brings them nearer: then the targets can't be had from these documents, ``Fit.met`` is false, and the rates
are those of least distance.

Targets sum to all present tokens (``keep="total"``), or are scaled so that the domain which is scarcest
against its share keeps its present tokens and the others shrink (``keep="scarcest"``). With ``keep="first"``
documents that are likeliest of the first domain count as of it alone and stay as they are, no rate is over 1,
and shares are upper bounds of the other domains, against the first: one that is below its share shrinks nothing.

A rate becomes copies: its whole part, and one more where a hash of the id falls below the rest.

Defined cases: a null text has no words and counts its end token; posteriors of such texts come from the
intercepts; very long texts are read whole; repeated ids draw alike; without labels of two domains all
posteriors are equal; an empty table gives an empty result; further columns pass through ``mixed`` and may
have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store
from leafspark.llm.text_features import DIM, features

VOCABULARY = 400
SAMPLE_ROWS = 10_000


def document_words(text: str | None) -> set[str]:
    """Distinct words without case and outer punctuation."""
    return {w.strip(".,;:!?\"'()").lower() for w in (text or "").split()} - {""}


@dataclass
class Classifier:
    """Softmax over dense features and the presence of telling words."""

    domains: list[str]
    words: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray | None = None

    def vector(self, text: str | None) -> np.ndarray:
        out = np.zeros(DIM + len(self.words))
        out[:DIM] = features(text)
        for w in document_words(text):
            if (k := self.words.get(w)) is not None:
                out[DIM + k] = 1
        return out

    def posteriors(self, texts: list[str | None]) -> np.ndarray:
        k = len(self.domains)
        if self.weights is None or not texts:
            return np.full((len(texts), k), 1 / k)
        z = np.stack([self.vector(t) for t in texts]) @ self.weights
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, k: int, ridge: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Weights by accelerated gradient descent."""
    w = v = np.zeros((x.shape[1], k))
    onehot = np.eye(k)[y]
    rate = 1 / (0.25 * np.linalg.norm(x, 2) ** 2 / len(x) + ridge)
    for t in range(steps):
        z = x @ v
        e = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (e / e.sum(axis=1, keepdims=True) - onehot) / len(x) + ridge * v
        new = v - 2 * rate * g
        v, w = new + t / (t + 3) * (new - w), new
    return w


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """labelled: doc_id and domain. About ``sample_rows`` labelled rows are learned from.

    Telling words are counted in executors over those rows; the driver gets a vocabulary of fixed size and
    the sample's feature vectors.
    """
    model = Classifier(domains)
    known = labelled.filter(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = store.cut(known, "known")
    known = store.bounded_sample(known, "doc_id", sample_rows, known.count())
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("t"))
    sample = store.cut(rows.join(F.broadcast(known), "doc_id"), "labelled")
    sizes = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    if len(sizes) < 2:
        return model

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(w, d) for t, d in zip(b.column("t").to_pylist(), b.column("domain").to_pylist()) for w in document_words(t)]
            w, d = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(d, pa.string())], names=["w", "d"])

    n = sum(sizes.values())
    counted = sample.select("t", "domain").mapInArrow(store.tidy(words), "w string, d string").groupBy("w").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("d") == d).alias(f"n{k}") for k, d in enumerate(domains)]
    )
    worth = F.lit(0.0)
    for k, d in enumerate(domains):
        expected = F.col("n") * (sizes.get(d, 0) / n)
        worth = worth + (F.col(f"n{k}") - expected) * (F.col(f"n{k}") - expected) / F.greatest(expected, F.lit(0.5))
    best = counted.filter("n >= 5").orderBy(F.desc(worth), "w").limit(VOCABULARY).select("w").collect()
    model.words = {r["w"]: i for i, r in enumerate(best)}

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [model.vector(t).astype("<f4").tobytes() for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("domain"), pa.array(made, pa.binary())], names=["domain", "x"])

    got = sample.select("t", "domain").mapInArrow(vectors, "domain string, x binary").collect()
    x = np.frombuffer(b"".join(r["x"] for r in got), "<f4").reshape(len(got), -1).astype(float)
    y = np.array([domains.index(r["domain"]) for r in got])
    model.weights = fit_softmax(x, y, len(domains))
    return model


MEMBER = pa.struct([("tokens", pa.int64()), ("p", pa.list_(pa.float64()))])


def memberships(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Written table of doc_id, tokens (words and an end) and p (posteriors, in the order of domains).

    With ``carry`` it also has each row of docs, as ``row``, so that ``mixed`` reads no text again.
    """

    def member(texts: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(texts), 256):
            part = texts.slice(i, 256).to_pylist()
            tokens = [len((t or "").split()) + 1 for t in part]
            p = pa.array(model.posteriors(part).tolist(), MEMBER.field("p").type)
            out.append(pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), p], fields=list(MEMBER)))
        return pa.concat_arrays(out) if out else pa.array([], MEMBER)

    found = F.arrow_udf(member, "tokens long, p array<double>")(docs[f"`{text}`"]).alias("member")
    row = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if carry else []
    table = store.cut(docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), found, *row), "members")
    return table.select("doc_id", "member.tokens", "member.p", *["row"] * carry)


@dataclass
class Fit:
    """kept: number of the domain whose likeliest documents keep rate 1; most: the highest rate."""

    targets: np.ndarray
    totals: np.ndarray
    steps: list[np.ndarray]
    kept: int | None = None
    most: float = float("inf")
    met: bool = True

    def rate(self, p: Column) -> Column:
        """1 - p.s1 - .. - p.sn, put into the bounds after each step, folded inside one expression."""
        made = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in self.steps])
        dot = lambda s: F.aggregate(F.zip_with(p, s, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        bound = lambda r: F.least(F.lit(self.most), F.greatest(F.lit(0.0), r))
        folded = F.aggregate(made, F.lit(1.0), lambda r, s: bound(r - dot(s))) if self.steps else F.lit(1.0)
        return F.when(self.free(p), folded).otherwise(F.lit(1.0))

    def free(self, p: Column) -> Column:
        """Whether a document's rate may move."""
        return F.lit(True) if self.kept is None else F.get(p, F.lit(self.kept)) < F.array_max(p)


def fit_rates(table: DataFrame, weights: list[float], keep: str = "total", tolerance: float = 1e-4, rounds: int = 200) -> Fit:
    """Projected gradient over all documents; every trial of a step gathers one row.

    ``tolerance`` is the largest miss as a share of its target. ``rounds`` only guards against a fit that neither
    arrives nor stalls, which is an error.
    """
    if keep not in ("total", "scarcest", "first"):
        raise ValueError("keep is total, scarcest or first")
    k = len(weights)
    share = np.asarray(weights, float) / sum(weights)
    p, t = F.col("p"), F.col("tokens").cast("double")
    goal = list(range(1, k)) if keep == "first" else list(range(k))

    def sums(fit: Fit) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of each domain, and second moments of the documents that can move."""
        whole = F.array(*[F.lit(float(i == fit.kept)) for i in range(k)])
        counted = F.when(fit.free(p), p).otherwise(whole)
        rows = table.select(counted.alias("p"), t.alias("t"), fit.rate(p).alias("r"), fit.free(p).alias("free"))
        at = lambda i: F.get("p", F.lit(i))
        moving = F.when(F.col("free") & ((F.col("r") > 0) | F.lit(not fit.steps)), F.col("t")).otherwise(0.0)
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        got = rows.agg(
            *[F.sum(F.col("r") * F.col("t") * at(i)).alias(f"s{i}") for i in range(k)],
            *[F.sum(moving * at(i) * at(j)).alias(f"h{i}_{j}") for i, j in pairs],
        ).collect()[0]
        shape = np.zeros((k, k))
        for i, j in pairs:
            shape[i, j] = shape[j, i] = got[f"h{i}_{j}"] or 0.0
        return np.array([got[f"s{i}"] or 0.0 for i in range(k)]), shape[np.ix_(goal, goal)]

    fit = Fit(np.zeros(k), np.zeros(k), [], 0 if keep == "first" else None, 1.0 if keep == "first" else float("inf"))
    fit.totals, shape = sums(fit)
    now, first = fit.totals, shape
    if keep == "first":
        fit.targets = np.minimum(now, share * now[0] / share[0])
    else:
        wanted = share > 0
        fit.targets = share * (now.sum() if keep == "total" else (now[wanted] / share[wanted]).min())
    allowed = tolerance * np.maximum(fit.targets[goal], tolerance * now.sum())
    ridge = 1e-9 * max(np.trace(first), 1e-9) * np.eye(len(goal))
    for _ in range(rounds):
        miss = (fit.totals - fit.targets)[goal]
        if (np.abs(miss) <= allowed).all():
            return fit
        better = None
        for base in (shape, first, np.diag(np.full(len(goal), np.trace(first) / 8))):  # the last is the plain gradient
            step = np.zeros(k)
            step[goal] = np.linalg.solve(base + ridge, miss)
            for half in range(6):
                tried = Fit(fit.targets, fit.totals, [*fit.steps, step * 0.5**half], fit.kept, fit.most)
                tried.totals, moved = sums(tried)
                if np.linalg.norm((tried.totals - fit.targets)[goal]) < 0.999 * np.linalg.norm(miss):
                    better = tried, moved
                    break
            if better:
                break
        if not better:
            fit.met = False
            return fit
        fit, shape = better
    raise RuntimeError("rates did not settle")


def copies_of(rate: Column, key: Column) -> Column:
    """Whole part of the rate, and one more with the chance of the rest."""
    draw = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    near = F.round(rate, 9)
    return (F.floor(near) + (draw < near - F.floor(near)).cast("long")).cast("int")


def rated(table: DataFrame, fit: Fit) -> DataFrame:
    """doc_id, tokens, p, rate and copies."""
    out = table.select("doc_id", "tokens", "p", fit.rate(F.col("p")).alias("rate"))
    return out.withColumn("copies", copies_of(F.col("rate"), F.col("doc_id")))


def mixed(table: DataFrame, fit: Fit) -> DataFrame:
    """The rows that a table of memberships carries, each as often as its copies."""
    boxed = table.select("row", copies_of(fit.rate(F.col("p")), F.col("doc_id")).alias("copies")).filter("copies > 0")
    return boxed.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
