"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. Each model is an
elastic-net logistic regression on hashed words and word beginnings; from the
second on, the probabilities of all earlier categories are features too. In
training these are out-of-fold predictions, so that a later model meets
earlier probabilities as they are on texts that the earlier model has not seen.

The models are fitted on a bounded sample of labelled rows (``fit_rows``, the
rows with the smallest hash of doc_id); every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import IS_MARK, U, Hasher, lists, text_chunks

BUCKETS = 1 << 20
BEGINNINGS = (5, 7, 9)  # bytes
LEAST_ROWS = 5  # rows of the sample that must hold a feature


@dataclass
class Linear:
    """weights: by bucket; chained: of the earlier categories' log odds; below ``threshold`` the answer is no."""

    buckets: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    bias: float
    threshold: float = 0.5


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear] = field(default_factory=list)


def features(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its document, words of each document): words and word beginnings, with repeats."""
    starts, ends, h, first = hasher.words(data, offsets, IS_MARK)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    buckets, docs = [h & U(BUCKETS - 1)], [doc]
    for n in BEGINNINGS:
        long = np.flatnonzero(ends - starts > n)
        buckets.append(hasher.spans(data, starts[long], starts[long] + n) * U(2 * n + 1) & U(BUCKETS - 1))
        docs.append(doc[long])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(docs), counts


def scale(words: np.ndarray) -> np.ndarray:
    """A feature's value in a document of so many words: 1 up to 300, then falling slowly, as chance hits grow with length."""
    return np.maximum(1, words / 300) ** -0.25


def distinct(buckets: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(docs * BUCKETS + buckets)
    return both % BUCKETS, both // BUCKETS


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Sparse:
    """Binary features of documents (columns below ``n``), each document's scaled by one value."""

    def __init__(self, cols: np.ndarray, ptr: np.ndarray, value: np.ndarray, n: int) -> None:
        self.cols, self.ptr, self.value, self.n = cols, ptr, value, n

    def rows(self, some: np.ndarray) -> Sparse:
        n = np.diff(self.ptr)[some]
        inside = np.zeros(len(self.ptr) - 1, dtype=bool)
        inside[some] = True  # ``some`` is in order
        return Sparse(self.cols[np.repeat(inside, np.diff(self.ptr))], np.concatenate([[0], np.cumsum(n)]), self.value[some], self.n)

    def columns(self, chosen: np.ndarray) -> Sparse:
        place = np.full(self.n, -1, dtype=np.int32)
        place[chosen] = np.arange(len(chosen), dtype=np.int32)
        cols = place[self.cols]
        inside = np.concatenate([[0], np.cumsum(cols >= 0)])
        return Sparse(cols[cols >= 0], inside[self.ptr], self.value, len(chosen))

    def dot(self, w: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(w[self.cols])])
        return (total[self.ptr[1:]] - total[self.ptr[:-1]]) * self.value

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, weights=np.repeat(g * self.value, np.diff(self.ptr)), minlength=self.n)


def fit_linear(x: Sparse, dense: np.ndarray, y: np.ndarray, l1: float = 2e-4, l2: float = 2e-4, rounds: int = 120) -> Linear:
    """Accelerated proximal gradient steps. Only features that LEAST_ROWS rows hold and that tell the classes apart take part."""
    if not len(y) or y.min() == y.max():  # one class, or no label at all: a constant
        rate = (y.sum() + 1) / (len(y) + 2) if len(y) else 1e-4
        return Linear(np.empty(0, int), np.empty(0), np.zeros(dense.shape[1]), float(logit(np.array(rate))))
    n = np.bincount(x.cols, minlength=x.n)
    pos = x.back(y / x.value)
    rate = y.mean()
    z = (pos - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate), 1e-9))
    chosen = np.flatnonzero((n >= LEAST_ROWS) & (np.abs(z) > 2))
    own = x.columns(chosen)
    center, spread = dense.mean(axis=0), dense.std(axis=0) + 1e-6
    d = (dense - center) / spread
    k = len(chosen)
    # a step length for each coordinate: column sums of |x| times row sums bound the curvature
    total = np.diff(own.ptr) * own.value + 1 + np.abs(d).sum(axis=1)
    curve = own.back(total) / (4 * len(y)) + 1e-9
    flat, wide = total.mean() / 4, (np.abs(d).T @ total) / (4 * len(y)) + 1e-9
    w, b, c = np.zeros(k), float(logit(np.array(rate))), np.zeros(d.shape[1])
    vw, vb, vc, t = w.copy(), b, c.copy(), 1.0
    for _ in range(rounds):
        g = (sigmoid(own.dot(vw) + d @ vc + vb) - y) / len(y)
        nw = vw - own.back(g) / curve
        nw = np.sign(nw) * np.maximum(np.abs(nw) - l1 / curve, 0) / (1 + l2 / curve)
        nb, nc = vb - g.sum() / flat, vc - (d.T @ g) / wide
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        f = (t - 1) / nt
        if (vw - nw) @ (nw - w) > 0:  # begin anew when the momentum points the wrong way
            f, nt = 0.0, 1.0
        vw, vb, vc = nw + f * (nw - w), nb + f * (nb - b), nc + f * (nc - c)
        w, b, c, t = nw, nb, nc, nt
    kept = w != 0
    return Linear(chosen[kept], w[kept], c / spread, b - float((c / spread) @ center))


def apply_linear(m: Linear, x: Sparse, dense: np.ndarray) -> np.ndarray:
    w = np.zeros(x.n)
    w[m.buckets] = m.weights
    return sigmoid(x.dot(w) + dense @ m.chained + m.bias)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where F1 is largest, in the middle of the gap to the next lower probability; 0.5 if a class is missing."""
    if not len(y) or y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(p[order][1:] < p[order][:-1], True)
    i = int(np.argmax(np.where(ends, f1, -1)))
    below = p[order][i + 1] if i + 1 < len(y) else 0.0
    return float((p[order][i] + below) / 2)


def fit_chain(x: Sparse, labels: dict[str, np.ndarray], folds: int = 5) -> Chain:
    """labels: by category 0, 1 or nan (unknown). Rows are dealt to folds in turn. The models' buckets are columns of x."""
    n = len(x.value)
    fold = np.arange(n) % folds
    dense = np.zeros((n, 0))
    chain = Chain(list(labels))
    for y in labels.values():
        known = ~np.isnan(y)
        ahead = np.zeros(n)
        for f in range(folds):
            there, here = np.flatnonzero(known & (fold != f)), np.flatnonzero(fold == f)
            m = fit_linear(x.rows(there), dense[there], y[there])
            ahead[here] = apply_linear(m, x.rows(here), dense[here])
        some = np.flatnonzero(known)
        model = fit_linear(x.rows(some), dense[some], y[some])
        model.threshold = best_threshold(ahead[some], y[some])
        chain.models.append(model)
        dense = np.column_stack([dense, logit(ahead)])
    return chain


def train(docs: DataFrame, labels: DataFrame, categories: list[str], fit_rows: int = 8000, folds: int = 5) -> Chain:
    """Fit the chain on at most ``fit_rows`` rows of ``labels`` (doc_id and a 0/1 column for each category).

    Null doc_id or no known category: not used. Several label rows of a document: the largest value of
    each category. Values other than 0 and 1: 1 if positive. A label whose document is missing is not used;
    repeated documents all take part. No labels: a chain that rejects nothing.
    """
    wanted = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max((F.col(c) > 0).cast("double")).alias(c) for c in categories]) \
        .where(F.coalesce(*[F.col(c) for c in categories]).isNotNull())
    sample = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)  # bounded: may be broadcast
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    schema = "doc_id bigint, " + ", ".join(f"y{i} double" for i in range(len(categories))) + ", words bigint, cols array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(True)
        names = ["doc_id", *[f"y{i}" for i in range(len(categories))], "words", "cols"]
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                buckets, doc, counts = features(hasher, data, offsets)
                cols, at = distinct(buckets, doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *[batch.column(2 + i).slice(a, b - a) for i in range(len(categories))],
                     pa.array(counts, pa.int64()),
                     lists(cols.astype(np.int32), np.bincount(at, minlength=b - a), pa.int32())], names)

    got = rows.select("doc_id", "text", *categories).mapInArrow(run, schema).toArrow()
    order = np.lexsort([got.column("words").to_numpy(), got.column("doc_id").to_numpy()])
    got = got.take(pa.array(order)).combine_chunks()
    cols = got.column("cols").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    ptr = np.concatenate([[0], np.cumsum(cols.value_lengths().to_numpy())]).astype(np.int64)
    every = Sparse(cols.flatten().to_numpy(), ptr, scale(got.column("words").to_numpy()), BUCKETS)
    held = np.flatnonzero(np.bincount(every.cols, minlength=BUCKETS) >= LEAST_ROWS)  # no fit uses others
    values = {c: got.column(f"y{i}").to_numpy(zero_copy_only=False).astype(float) for i, c in enumerate(categories)}
    x = every.columns(held)
    del every, cols, got
    chain = fit_chain(x, values, folds)
    for m in chain.models:
        m.buckets = held[m.buckets]
    return chain


def probabilities(chain: Chain) -> object:
    """A function (hasher, data, offsets) -> one line per category of probabilities; made once in a task."""
    held = np.unique(np.concatenate([m.buckets for m in chain.models]))
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[held] = np.arange(len(held), dtype=np.int32)
    table = np.zeros((len(chain.models), len(held)))
    for i, m in enumerate(chain.models):
        table[i, place[m.buckets]] = m.weights

    def of(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        buckets, doc, counts = features(hasher, data, offsets)
        own = place[buckets]
        cols, at = distinct(own[own >= 0].astype(np.int64), doc[own >= 0])
        value, n = scale(counts), len(counts)
        p = np.zeros((len(chain.models), n))
        for i, m in enumerate(chain.models):
            score = np.bincount(at, weights=table[i, cols], minlength=n) * value
            p[i] = sigmoid(score + m.chained @ logit(p[:i]) + m.bias)
        return p

    return of


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id, p_<category>..., is_<category>...`` for every row of ``docs``. Null or empty text: the probability without any word."""
    categories = chain.categories
    names = ["doc_id", *[f"p_{c}" for c in categories], *[f"is_{c}" for c in categories]]
    schema = ", ".join(["doc_id bigint", *[f"p_{c} double" for c in categories], *[f"is_{c} boolean" for c in categories]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, of = Hasher(True), probabilities(chain)
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                p = of(hasher, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *map(pa.array, p),
                     *[pa.array(q >= m.threshold) for q, m in zip(p, chain.models, strict=True)]], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def reject(docs: DataFrame, chain: Chain, category: str) -> DataFrame:
    """``docs``, all columns, without the rows that the chain puts into ``category``."""
    at, text = chain.categories.index(category), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, of = Hasher(True), probabilities(chain)
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(text)):
                keep = of(hasher, data, offsets)[at] < chain.models[at].threshold
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


CATEGORIES = ["low_quality", "toxic", "toxic_low_quality"]


def label_categories(labels: DataFrame) -> DataFrame:
    """The chain's categories from ``labels`` (doc_id, quality 0/1, toxic 0/1): low quality, toxic, and both."""
    low = (F.col("quality") <= 0).cast("int")
    toxic = (F.col("toxic") > 0).cast("int")
    return labels.select("doc_id", low.alias("low_quality"), toxic.alias("toxic"), (low * toxic).alias("toxic_low_quality"))
