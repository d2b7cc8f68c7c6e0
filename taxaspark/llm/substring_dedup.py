"""Removal of passages that occur more than once, by winnowing anchors and window lookup.

This stands in for a greedy relative Lempel-Ziv parse, which is not built: there are no factors (start, length,
source) and no reference blocks. Only which windows occur again decides what goes, and that is found exactly.

The corpus is its own reference. An anchor is a 16-word gram whose hash is the
smallest in some window (of ``window`` words), so equal windows hold equal
anchors. The index (the anchors of one hash, with a print of the words
around each) tells how far a document can be copied from elsewhere:

* **Copied**: an anchor whose whole surroundings (all windows it stands for) occur again. Runs of
  such anchors are the long copies; their windows are duplicates with no further look.
* **Edge**: an anchor that occurs again, in other surroundings. A copy begins or ends
  near it, so each of its windows is looked up by itself, against those of the other
  occurrences (one for each distinct surroundings).
* All else. They are never looked up.

Matching every document against every other would be quadratic; looking up
only the entries of a document's own anchors finds the same windows. Prints are 128 bits
(gram and surroundings, or two window hashes).

Within an Arrow batch, equal entries are sent once, so that a passage in a third
of all documents is as many rows as there are batches, not documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import text_print, written
from .words import U, Hasher, grouped, lists, mix, ngrams, powers, text_chunks

GRAM = 16
NONE, COPIED, EDGE, COPIED_SHOWN = 0, 1, 2, 3  # what an anchor is; SHOWN: its windows are looked up by others


def sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op (minimum, maximum) over n consecutive values, by doubling."""
    out, done = x, 1
    while done < n:
        step = min(done, n - done)
        out = op(out[: len(out) - step], out[step:])
        done += step
    return out


class Anchors:
    """The windows and anchors of the documents of a chunk (hashes h, document bounds first)."""

    def __init__(self, h: np.ndarray, first: np.ndarray, window: int) -> None:
        self.h, self.first, self.window = h, first, window
        self.span = window - GRAM + 1
        counts = np.diff(first)
        doc = np.repeat(np.arange(len(counts)), counts)
        if len(h) < window:
            self.low = self.at = np.empty(0, dtype=U)
            self.at = self.at.astype(np.int64)
            self.doc, self.gram, self.valid = doc, self.low, self.low.astype(bool)
            return
        self.gram = ngrams(h, GRAM) | U(1)
        self.doc = doc
        self.valid = doc[: len(h) - window + 1] == doc[window - 1 :]
        self.low = np.where(self.valid, sliding(self.gram, self.span, np.minimum), U(0))
        pad = np.zeros(self.span - 1, dtype=U)
        top = sliding(np.concatenate([pad, self.low, pad]), self.span, np.maximum)
        self.at = np.flatnonzero(self.gram == top)

    def surroundings(self) -> np.ndarray:
        """A print of the words that the windows of each anchor cover, and of where the anchor stands in them."""
        if not len(self.at):
            return np.empty(0, dtype=U)
        doc = self.doc[self.at]
        lo = np.maximum(self.at - self.span + 1, self.first[doc])
        hi = np.minimum(self.at + self.window, self.first[doc + 1])
        total = np.zeros(len(self.h) + 1, dtype=U)
        base = 0xD1342543DE82EF95
        up, down = powers(base, len(self.h)), powers(pow(base, -1, 2**64), len(self.h))
        with np.errstate(over="ignore"):
            np.cumsum(self.h * up[:-1], out=total[1:], dtype=U)
            return mix(mix((total[hi] - total[lo]) * down[lo]) + ((self.at - lo) * 1024 + (hi - lo)).astype(U))

    def windows_of(self, positions: np.ndarray) -> np.ndarray:
        """The starts of all windows whose smallest gram is one of those at ``positions``, in order, once."""
        starts = positions[:, None] - np.arange(self.span)[None, :]
        inside = (starts >= 0) & (starts < len(self.low))
        safe = np.where(inside, starts, 0)
        hit = inside & (self.low[safe] == self.gram[positions][:, None]) & self.valid[safe]
        return np.unique(safe[hit])


def once(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the first of each distinct key in key order, how many have the key, class of each row)."""
    order = np.lexsort(keys[::-1])
    change = np.ones(len(order), dtype=bool)
    if len(order):
        change[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    cls = np.empty(len(order), dtype=np.int64)
    cls[order] = np.cumsum(change) - 1
    return order[change], np.bincount(cls) if len(order) else np.empty(0, np.int64), cls


def anchor_index(docs: DataFrame, window: int) -> DataFrame:
    """``gram, around, doc_id, fp, pos, many`` of all anchors. In a batch, one row stands for equal (gram, around): ``many``,
    and the others are rows without a gram: they are known to be copied."""
    schema = "gram bigint, around bigint, doc_id bigint, fp bigint, pos int, many boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(False)
        for batch in batches:
            parts = []
            for a, _, data, offsets in text_chunks(batch.column(2)):
                _, _, h, first = hasher.words(data, offsets)
                anchors = Anchors(h, first, window)
                doc = anchors.doc[anchors.at] if len(anchors.at) else anchors.at
                parts.append((anchors.gram[anchors.at], anchors.surroundings(), doc + a, anchors.at - first[doc]))
            if not parts:
                continue
            gram, around, row, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
            first_row, counts, cls = once([gram, around])
            lead = np.zeros(len(gram), dtype=bool)
            lead[first_row] = True
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64), mask=~lead), pa.array(around.view(np.int64), mask=~lead),
                 batch.column(0).take(take), batch.column(1).take(take), pa.array(pos.astype(np.int32)),
                 pa.array(counts[cls] > 1)], ["gram", "around", "doc_id", "fp", "pos", "many"])

    return docs.mapInArrow(run, schema)


def marked_anchors(index: DataFrame) -> DataFrame:
    """``doc_id, fp, marks`` (array of pos * 4 + mark) of the documents with an anchor that occurs again."""
    leads = index.where("gram is not null")
    # tables that are joined by a gram that may be hot are written: Spark can then split the other side's partition
    again = written(leads.groupBy("gram").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).where("n > 1")
                    .select("gram"), "repeated-grams")
    there = written(leads.join(again, "gram"), "repeated-anchors")
    # one row for each distinct surroundings: its first place, and whether it is the only one
    places = there.groupBy("gram", "around").agg(
        F.min(F.struct("doc_id", "fp", "pos")).alias("shown"), F.count(F.lit(1)).alias("n"), F.max("many").alias("many"))
    copied = (F.col("n") > 1) | F.col("many")
    kinds = written(places.select("gram", "around", "shown", copied.alias("copied")), "surroundings")
    edges = written(kinds.groupBy("gram").agg(F.max(~F.col("copied")).alias("edges")), "edges")
    shown = kinds.join(edges, "gram").select(
        "shown.*", F.when(~F.col("copied"), EDGE).when(F.col("edges"), COPIED_SHOWN).otherwise(COPIED).alias("mark"))
    # all places of copied surroundings are copied; the marks of one place are united below
    others = there.join(kinds.where("copied").select("gram", "around"), ["gram", "around"]).select(
        "doc_id", "fp", "pos", F.lit(COPIED).alias("mark"))
    local = index.where("gram is null").select("doc_id", "fp", "pos", F.lit(COPIED).alias("mark"))
    marks = shown.unionByName(others).unionByName(local)
    return marks.groupBy("doc_id", "fp").agg(F.collect_list(F.col("pos").cast("long") * 4 + F.col("mark")).alias("marks"))


def duplicate_starts(docs: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """``doc_id, fp, starts`` (array): the windows that occur again; several rows for a document."""
    schema = "w1 bigint, w2 bigint, doc_id bigint, fp bigint, starts array<int>, kind int"
    own = docs.join(marks.withColumnRenamed("doc_id", "_id").withColumnRenamed("fp", "_fp"),
                    F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp"))).select("doc_id", "fp", "text", "marks")
    names = ["w1", "w2", "doc_id", "fp", "starts", "kind"]

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Kind 0: a window to look up; 1: one to look up that is known to occur again; 2: a document's known duplicates."""
        hasher = Hasher(False)
        for batch in batches:
            known, looked = [], []
            for a, b, data, offsets in text_chunks(batch.column(2)):
                _, _, h, first = hasher.words(data, offsets)
                anchors = Anchors(h, first, window)
                if not len(anchors.low):
                    continue
                column = batch.column(3).slice(a, b - a)
                marks_ = column.flatten().to_numpy()
                doc = np.repeat(np.arange(b - a), column.value_lengths().to_numpy())
                pos, mark = first[doc] + (marks_ >> 2), marks_ & 3
                sure = anchors.windows_of(np.unique(pos[mark != EDGE]))
                look = anchors.windows_of(np.unique(pos[mark >= EDGE]))
                known.append((anchors.doc[sure] + a, sure - first[anchors.doc[sure]]))
                w1, w2 = (ngrams(h, window, seed) for seed in (11, 12))
                looked.append((w1[look], w2[look], anchors.doc[look] + a, look - first[anchors.doc[look]],
                               np.isin(look, sure, assume_unique=True)))
            if not known:
                continue
            row, start = (np.concatenate(c) for c in zip(*known, strict=True))
            docs_, sizes = np.unique(row, return_counts=True)  # in order of rows
            w1, w2, at, s, sure = (np.concatenate(c) for c in zip(*looked, strict=True))
            lead, counts, cls = once([w1, w2])
            twice = counts[cls] > 1
            # windows that are equal within the batch are known; one of them is sent for the others
            more = np.flatnonzero(twice & ~sure)
            kind = np.where(counts > 1, 1, np.where(sure[lead], 1, 0)).astype(np.int32)
            extra_docs = at[more]
            order = np.argsort(extra_docs, kind="stable")
            e_docs, e_sizes = np.unique(extra_docs, return_counts=True)
            out_rows = np.concatenate([at[lead], docs_, e_docs])
            flat = np.concatenate([s[lead], start, s[more][order]]).astype(np.int32)
            sizes = np.concatenate([np.ones(len(lead), np.int64), sizes, e_sizes])
            fill = len(docs_) + len(e_docs)
            take = pa.array(out_rows)
            salt = mix(out_rows[len(lead):].astype(U))  # rows that are only passed on go anywhere
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([w1[lead], salt]).view(np.int64)), pa.array(np.concatenate([w2[lead], np.arange(fill, dtype=U)]).view(np.int64)),
                 batch.column(0).take(take), batch.column(1).take(take), lists(flat, sizes, pa.int32()),
                 pa.array(np.concatenate([kind, np.full(fill, 2, np.int32)]))], names)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in grouped(batches, ["w1", "w2"]):
            kind = table.column("kind").to_numpy()
            size = np.diff(cuts)
            sure = np.add.reduceat((kind == 1).astype(np.int64), cuts[:-1]) > 0
            real = np.add.reduceat((kind < 2).astype(np.int64), cuts[:-1])
            hit = np.repeat(sure | (real > 1), size)
            keep = (kind == 2) | ((kind == 0) & hit)
            yield from table.select(["doc_id", "fp", "starts"]).filter(pa.array(keep)).combine_chunks().to_batches()

    rows = own.mapInArrow(factor, schema).repartition("w1").sortWithinPartitions("w1", "w2")
    return rows.mapInArrow(again, "doc_id bigint, fp bigint, starts array<int>")


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, fp, n_words, n_removed, spans, text``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged (null text: none). A word is removed if
    a window of ``window`` consecutive words covers it whose word sequence also
    starts anywhere else, in the same document too; windows are judged on the
    input. ``spans``: (first word, number) of what is removed; ``text``: the kept
    words with single spaces. Documents of fewer words stay whole. Rows that repeat doc_id and text
    are occurrences of their own. Null doc_id: an id like others.
    ``window`` must be more than 16 and less than 500.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_print(F.col("text")).alias("fp"), "text")
    index = written(anchor_index(own.select("doc_id", "fp", "text"), window), "anchors")
    starts = duplicate_starts(own, marked_anchors(index), window).groupBy(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).agg(
        F.flatten(F.collect_list("starts")).alias("starts"))
    found = own.join(starts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")), "left") \
        .select("doc_id", "fp", "text", "starts")
    schema = "doc_id bigint, fp bigint, n_words bigint, n_removed bigint, spans array<struct<first:int,n:int>>, text string"
    names = ["doc_id", "fp", "n_words", "n_removed", "spans", "text"]

    def cut(text: str | None, starts: list[int] | None) -> tuple:
        words = (text or "").encode().split()  # bytes.split: exactly the six separators
        spans: list[dict] = []
        if starts is not None and len(starts):
            s = np.unique(starts)
            begin = s[np.append(True, np.diff(s) > window)]
            end = s[np.append(np.diff(s) > window, True)] + window
            spans = [{"first": int(a), "n": int(b - a)} for a, b in zip(begin, end, strict=True)]
        kept, at = [], 0
        for x in spans:
            kept += words[at : x["first"]]
            at = x["first"] + x["n"]
        kept += words[at:]
        return len(words), len(words) - len(kept), spans, b" ".join(kept).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])), pa.string()]
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                starts_ = [None if x is None else np.asarray(x) for x in some.column(3).to_pylist()]
                rows = [cut(t, s) for t, s in zip(some.column(2).to_pylist(), starts_, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names)

    return found.mapInArrow(run, schema)
