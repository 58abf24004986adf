"""Quality by positive-unlabelled learning: a linear scorer of least non-negative unbiased risk.

With f(x) = w.x and the squared loss, the risk pi * Rp(+) + max(0, Ru(-) - pi * Rp(-)) depends on the data
only through first and second moments of the features over the trusted positives and over all text. One pass
sums those, over every document, into a matrix whose size is the number of features; the driver then
descends the exact risk, taking the step that raises the negative part wherever that has gone below zero.
The class prior is the ratio of the unlabelled to the positive share above a score, where that ratio's
upper bound is least (read from histograms of all scores), and the scorer is fitted again with it.

The probability of quality at a value of f is the prior times the density of positives over the density of all
text there. A logistic curve g is fitted to that ratio by least squares, whose risk, E_all[g^2] / 2 less the prior
times E_positives[g], needs the two histograms only. So positives, unlabelled text and the prior give scores and
probabilities alike; negative labels are not read at all.

Features are figures of a text (shares of character classes, repetition, length) and the shares of its words in
hashed buckets, all from the whole text.

Defined cases: null and empty texts are scored as texts without words, very long texts whole; equal texts score equally; rows with
null or repeated ids are scored as they are, and of several labels for an id the least holds; without
positives every score is 0.5; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.llm import store, text_features
from leafspark.llm.shingles import word_hashes

BUCKET_BITS = 6
DIM = text_features.DIM + (1 << BUCKET_BITS)
SCORE_BINS = 400
SCORE_SPAN = 2.0


def features(text: str | None) -> np.ndarray:
    """DIM numbers in [0, 1], the last one 1: hashed word shares, then figures."""
    out = np.zeros(DIM)
    raw = (text or "").encode("utf-8", "surrogatepass")
    _, words = word_hashes(np.frombuffer(raw + b" ", np.uint8))
    if len(words):
        n = np.bincount((words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
        out[: 1 << BUCKET_BITS] = np.sqrt(n / len(words))
    out[1 << BUCKET_BITS :] = text_features.features(text)
    return out


@dataclass
class Moments:
    """Mean and mean outer product of features."""

    n: int
    first: np.ndarray
    second: np.ndarray


def logistic(f: np.ndarray, slope: float, middle: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * (f - middle), -30, 30)))


@dataclass
class Model:
    weights: np.ndarray
    prior: float
    slope: float
    middle: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(x @ self.weights, self.slope, self.middle)


def held_out(key: str) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def featured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Written table of doc_id and its features (32-bit floats)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [features(t.as_py()).astype("<f4").tobytes() for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(made, pa.binary())], names=["doc_id", "x"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return store.cut(rows.mapInArrow(store.tidy(run), "doc_id long, x binary"), "features")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, DIM).astype(float)


def moments(table: DataFrame) -> Moments:
    """Over all rows of a table of features; the driver gets DIM * (DIM + 1) / 2 sums."""
    i, j = np.triu_indices(DIM)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DIM, DIM))
        for b in batches:
            x = _matrix(b.column("x"))
            total += x.T @ x
        cols = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(cols, names=["i", "j", "v"])

    sums = table.select("x").mapInArrow(store.tidy(run), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((DIM, DIM))
    for r in sums.collect():
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["v"]
    n = int(round(total[-1, -1]))  # the last feature is 1
    return Moments(n, total[-1] / max(n, 1), total / max(n, 1))


def _squared(m: Moments, w: np.ndarray, sign: int) -> tuple[float, np.ndarray]:
    """Mean of (1 - sign * f)^2 / 4 and its gradient."""
    mw = m.second @ w
    return (1 - 2 * sign * m.first @ w + w @ mw) / 4, (mw - sign * m.first) / 2


def fit_weights(pos: Moments, all_: Moments, prior: float, least_ridge: float = 5e-3, steps: int = 3000) -> np.ndarray:
    """Weights of least non-negative risk, from a preconditioned descent; few positives get a firmer ridge."""
    ridge = least_ridge + 0.25 * DIM / max(pos.n, 1)
    shape = np.linalg.inv(all_.second + pos.second + (1e-3 + 2 * ridge) * np.eye(DIM))
    w = np.zeros(DIM)
    for _ in range(steps):
        _, positive = _squared(pos, w, 1)
        ru, gu = _squared(all_, w, -1)
        rp, gp = _squared(pos, w, -1)
        rest, g = ru - prior * rp, gu - prior * gp
        step = prior * positive + g + ridge * w if rest >= 0 else -g
        move = shape @ step
        w = w - 0.5 * move
        if np.abs(move).max() < 1e-7:
            break
    return w


def _histogram(table: DataFrame, w: np.ndarray) -> np.ndarray:
    """Counts of f, in SCORE_BINS bins of [-SCORE_SPAN, SCORE_SPAN]."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SCORE_BINS, dtype=np.int64)
        for b in batches:
            at = (_matrix(b.column("x")) @ w / SCORE_SPAN + 1) / 2 * SCORE_BINS
            total += np.bincount(np.clip(at, 0, SCORE_BINS - 1).astype(int), minlength=SCORE_BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SCORE_BINS)), pa.array(total)], names=["b", "n"])

    out = np.zeros(SCORE_BINS)
    for r in table.select("x").mapInArrow(store.tidy(run), "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def prior_of(pos: np.ndarray, all_: np.ndarray, n: int, doubt: float = 0.1) -> float:
    """Ratio of shares above the score where its upper bound, at that much doubt, is least; n positives were scored."""
    up = lambda h: np.cumsum(h[::-1])[::-1] / max(h.sum(), 1)
    p, u = up(pos), up(all_)
    slack = np.sqrt(np.log(4 / doubt) / (2 * max(n, 1)))
    ok = p > slack
    if not ok.any():
        return 0.5
    best = np.argmin(np.where(ok, (u + slack) / np.maximum(p, 1e-12), np.inf))
    return float(np.clip(u[best] / p[best], 0.05, 0.99))


def curve(pos: np.ndarray, all_: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and middle of the logistic curve of least squared-loss risk, on a grid that narrows."""
    f = -SCORE_SPAN + 2 * SCORE_SPAN / SCORE_BINS * (np.arange(SCORE_BINS) + 0.5)
    p, u = prior * pos / max(pos.sum(), 1), all_ / max(all_.sum(), 1)
    slope, middle, wide = 8.0, 0.0, 1.0
    for _ in range(6):
        slopes = np.clip(slope * 8.0 ** np.linspace(-wide, wide, 25), 1.0, 60.0)
        middles = middle + wide * np.linspace(-1.5, 1.5, 61)
        g = logistic(f, slopes[:, None, None], middles[None, :, None])
        risk = g**2 @ u / 2 - g @ p
        i, j = np.unravel_index(np.argmin(risk), risk.shape)
        slope, middle, wide = slopes[i], middles[j], wide / 3
    return float(slope), float(middle)


def fit(table: DataFrame, labels: DataFrame) -> Model:
    """labels: doc_id and quality of training rows, of which those of quality 1 are the trusted positives.

    Prior and curve are read from positives that the scorer at hand was not fitted to: each half of them is scored
    by the weights of the other half. The weights that are kept are of all positives.
    """
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    half = (F.xxhash64("doc_id") % 2 == 0).alias("half")
    positives = store.cut(table.join(known, "doc_id", "left_semi").select("x", half), "positives")
    halves = [positives.filter("half"), positives.filter("not half")]
    sums, all_ = [moments(h) for h in halves], moments(table)
    n = sum(m.n for m in sums)
    if not n:
        return Model(np.zeros(DIM), 0.5, 1.0, 0.0)
    pos = Moments(n, sum(m.first * m.n for m in sums) / n, sum(m.second * m.n for m in sums) / n)
    if not all(m.n for m in sums):
        sums, halves = [pos, pos], [positives, positives.limit(0)]

    def scores(prior: float) -> tuple[np.ndarray, np.ndarray]:
        """Histograms of positives and of all text, by the weights of the other half."""
        crossed = [fit_weights(m, all_, prior) for m in reversed(sums)]
        return (
            sum(_histogram(h, w) for h, w in zip(halves, crossed)),
            sum(_histogram(table, w) * m.n for m, w in zip(reversed(sums), crossed)),
        )

    prior = prior_of(*scores(0.5), n)
    prior = prior_of(*(last := scores(prior)), n)
    return Model(fit_weights(pos, all_, prior), prior, *curve(*last, prior))


def scored(table: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of a table of features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_matrix(b.column("x")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return table.mapInArrow(store.tidy(run), "doc_id long, score double")
