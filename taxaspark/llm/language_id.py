"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (1 to 3) of the lower-cased letters and
spaces of a text, with term frequencies per text and inverse document frequencies counted over every
document that may be learnt from. The model is trained with
follow-the-regularised-leader (a proximal step for each text, elastic-net
penalties), on a bounded sample (``fit_rows``), and its scores are
calibrated with one temperature on texts of the sample that the training left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import U, lists, mix, randoms, text_chunks

BITS = 15
BUCKETS = 1 << BITS
ORDERS = (1, 2, 3)
ASCII_LETTER = re.compile(r"[A-Za-z]")
UNKNOWN = "und"


@dataclass
class Model:
    """weights: bucket x language, with the IDF already in; scores are divided by the temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def has_letter(text: str | None) -> bool:
    """A character of a Unicode letter category."""
    return text is not None and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a chunk's texts and the first of each text, from UTF-8."""
    text = data.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    heads = np.cumsum((data & 0xC0) != 0x80)
    return points, np.concatenate([[0], heads])[offsets]


def fold(points: np.ndarray) -> np.ndarray:
    """Lower case for the Latin, Greek and Cyrillic blocks that map by an offset. Every code point from U+00AA
    counts as a letter, so marks beyond ASCII are parts of n-grams like letters; the rest becomes 0."""
    p = points.copy()
    upper = ((p >= 65) & (p <= 90)) | ((p >= 0xC0) & (p <= 0xDE) & (p != 0xD7)) | ((p >= 0x391) & (p <= 0x3A9)) | ((p >= 0x410) & (p <= 0x42F))
    p[upper] += 32
    letter = ((p >= 97) & (p <= 122)) | (p >= 0xAA)
    p[~letter] = 0
    return p


def grams(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every n-gram that stays in its text and does not begin or end in two gaps."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    p = fold(points).astype(U)
    factors = randoms(max(ORDERS), 31) | U(1)
    buckets, docs = [], []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            m = len(p) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, dtype=U)
            letters = np.zeros(m, dtype=bool)
            for k in range(n):
                h += p[k : k + m] * factors[k]
                letters |= p[k : k + m] != 0
            inside = letters & (doc[:m] == doc[n - 1 :])
            if n == 3:
                inside &= p[1 : 1 + m] != 0
            buckets.append((mix(h[inside]) >> U(64 - BITS)).astype(np.int64))
            docs.append(doc[:m][inside])
    return np.concatenate(buckets) if buckets else np.empty(0, np.int64), np.concatenate(docs) if docs else np.empty(0, np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents that hold each bucket, documents), over all rows of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(0), 1 << 19):
                points, first = code_points(data, offsets)
                buckets, doc = grams(points, first)
                held = np.zeros((b - a) * BUCKETS, dtype=bool) if (b - a) <= 512 else None
                if held is not None:
                    held[doc * BUCKETS + buckets] = True
                    total += held.reshape(b - a, BUCKETS).sum(axis=0)
                else:
                    total += np.bincount(np.unique(doc * BUCKETS + buckets) % BUCKETS, minlength=BUCKETS)
                n += b - a
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()  # a row for each bucket at most
    df = np.zeros(BUCKETS, dtype=np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return df, int(n[at < 0].sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, alpha: float = 2.0, beta: float = 1.0,
         l1: float = 0.01, l2: float = 0.01, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic-net penalties, a text at a time: weights (buckets x classes) and bias."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    order = np.argsort(mix(np.arange(len(rows), dtype=U)), kind="stable")  # mixed, so that classes alternate

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0)

    for _ in range(epochs):
        for i in order:
            at, value = rows[i]
            w = weights(z[at], n[at])
            s = value @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = value[:, None] * p[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights(z, n)
    return w[:BUCKETS], w[BUCKETS]


def best_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden section over its logarithm; 1 without texts."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

    lo, hi, g = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, learnable: Column, fit_rows: int = 4000, held_back: int = 5) -> Model:
    """Fit on ``docs`` (doc_id, text, lang): IDF on all learnable rows with a lang, weights on ``fit_rows`` of them at most.

    The sample is the rows with the smallest hash of doc_id; every ``held_back``-th of it sets the temperature. Rows with null
    lang or without letters are not used for the weights. No usable row: a model that answers ``und``; one language: always that.
    """
    own = docs.where(learnable & F.col("lang").isNotNull())
    df, total = document_frequencies(own)
    ids = own.where("lang is not null and doc_id is not null and text is not null").select("doc_id").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(fit_rows)  # bounded: may be broadcast
    rows = own.join(F.broadcast(ids.distinct()), "doc_id").where("lang is not null").select("doc_id", "text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1), 1 << 19):
                points, first = code_points(data, offsets)
                buckets, doc = grams(points, first)
                key, n = np.unique(doc * BUCKETS + buckets, return_counts=True)
                sizes = np.bincount(key // BUCKETS, minlength=b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                     lists((key % BUCKETS).astype(np.int32), sizes, pa.int32()), lists(n.astype(np.int32), sizes, pa.int32())],
                    ["doc_id", "lang", "at", "n"])

    got = rows.mapInArrow(run, "doc_id bigint, lang string, at array<int>, n array<int>").toArrow()
    sample = sorted(((i, lang, at, n) for i, lang, at, n in zip(
        got.column("doc_id").to_pylist(), got.column("lang").to_pylist(), got.column("at"), got.column("n"), strict=True)
        if len(at)), key=lambda r: r[:2])
    languages = sorted({r[1] for r in sample})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    idf = np.log((1 + total) / (1 + df)) + 1
    vectors = []
    for _, _, at, n in sample:
        at, n = at.values.to_numpy(), n.values.to_numpy()
        vectors.append((np.append(at, BUCKETS), np.append(SCALE * n / n.sum() * idf[at], 1.0)))
    y = np.array([languages.index(r[1]) for r in sample])
    later = np.arange(len(y)) % held_back == held_back - 1
    w, bias = ftrl([v for v, h in zip(vectors, later, strict=True) if not h], y[~later], len(languages))
    scores = np.array([v[:-1] @ w[at[:-1]] + bias for (at, v), h in zip(vectors, later, strict=True) if h])
    return Model(languages, w * (SCALE * idf)[:, None], bias, best_temperature(scores, y[later]))


SCALE = 3.0  # of a text's term frequencies, which add up to one for all its n-grams


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (doc_id, text), from the text alone.

    Null text, or a text without a letter: ``und`` with score 0. Repeated rows get equal answers.
    """
    k = len(model.languages)
    table = np.ascontiguousarray(model.weights.T.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            letters = np.array([has_letter(t) for t in texts.to_pylist()], dtype=bool)
            for a, b, data, offsets in text_chunks(texts, 1 << 19):
                points, first = code_points(data, offsets)
                buckets, doc = grams(points, first)
                n = np.maximum(np.bincount(doc, minlength=b - a), 1)
                s = np.array([np.bincount(doc, weights=table[j, buckets], minlength=b - a) / n for j in range(k)]).reshape(k, b - a).T
                s = (s + model.bias) / model.temperature
                known = letters[a:b] & (k > 0)
                p = np.exp(s - s.max(axis=1, keepdims=True)) if k else np.zeros((b - a, 1))
                p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
                best = p.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([model.languages[j] if ok else UNKNOWN for j, ok in zip(best.tolist(), known.tolist(), strict=True)], pa.string()),
                     pa.array(np.where(known, p[np.arange(b - a), best], 0.0))], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")
