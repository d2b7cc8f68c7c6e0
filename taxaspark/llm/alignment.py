"""Alignment of two tokenizers' tokens over the same bytes, by interval coalescing.

Tokens of both sides are byte ranges. All of them are sorted by start, the
running maximum of their ends is taken, and a group breaks where a start
reaches that maximum: there tokens of both sides end. Inside the groups every
pair of overlapping tokens is expanded; pairs that also end together are links.

A task aligns a chunk of whole documents at once (their bytes laid end to end).
The counts of linked id pairs over the whole corpus are added up from the chunks' own
counts; every chunk then gets the counts of its own pairs back. So what is
shuffled is a row for each chunk and distinct pair, not for each token, and no table of pairs
is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import PLAIN, Encoder
from .tables import written

#: characters of text that a chunk holds (a longer document is a chunk of its own)
CHUNK = 1 << 20

DOC = ("struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string,"
       "codes:array<int>,times:array<int>>")


class ByteLevel:
    """Side A: a byte-level BPE file; ids of space and text, special tokens' strings as plain text."""

    def __init__(self, path: str) -> None:
        self.encoder = Encoder(path)
        self.encoder.special = []
        self.encoder.tokenizer.encode_special_tokens = True
        other = iter(range(256))
        letters = {chr(b) if b in PLAIN else chr(256 + next(other)): b for b in range(256)}
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes[i] = bytes(letters[c] for c in token)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.encode(" " + text), dtype="<u4").astype(np.int32)


class Pieces:
    """Side B: a sentencepiece model, which adds the space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.model.encode(text, num_threads=1), dtype=np.int32)


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (from 0) of every A and every B token."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side = np.repeat([0, 1], [len(a_start), len(b_start)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(np.concatenate([[0], start[order][1:] >= reach[:-1]]))
    return group[: len(a_start)], group[len(a_start) :]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose ranges overlap; they never leave a group."""
    low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    times = high - low
    a = np.repeat(np.arange(len(a_start)), times)
    b = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
    return a, b


class Aligner:
    """Chunks of documents to rows."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.sides = [ByteLevel(a_path), Pieces(b_path)]
        self.sizes = [np.array([len(x) for x in s.bytes], dtype=np.int64) for s in self.sides]
        self.names = [np.array([str(i) for i in range(len(s.bytes))], dtype=object) for s in self.sides]

    def tokens(self, text: str | None) -> list[np.ndarray]:
        """The ids of both sides; none if there is no text, or a side's bytes are not those of space and text."""
        none = [np.empty(0, np.int32), np.empty(0, np.int32)]
        if not text:
            return none
        whole, out = (" " + text).encode(), []
        for side in self.sides:
            ids = side.encode(text)
            if b"".join([side.bytes[i] for i in ids.tolist()]) != whole:
                return none
            out.append(ids)
        return out

    def written_groups(self, ids: list[np.ndarray], groups: list[np.ndarray], doc: list[np.ndarray], n_docs: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each document."""
        names = np.concatenate([t[i] for t, i in zip(self.names, ids, strict=True)])
        group, owner = np.concatenate(groups), np.concatenate(doc)
        side = np.repeat([0, 1], [len(i) for i in ids])
        order = np.lexsort((side, group))  # stable: tokens of a side stay in order
        group, side, owner = group[order], side[order], owner[order]
        text = np.full(2 * len(order), ",", dtype=object)
        text[0::2] = names[order]
        text[1:-1:2][side[1:] != side[:-1]] = "|"
        text[1:-1:2][group[1:] != group[:-1]] = ";"
        ends = np.searchsorted(owner, np.arange(n_docs), "right")
        parts, low, out = text.tolist(), 0, []
        for high in ends.tolist():
            out.append("".join(parts[2 * low : 2 * high - 1]) if high > low else "")
            low = high
        return out

    def row(self, chunk: int, docs: list[tuple[int | None, list[np.ndarray]]]) -> pa.RecordBatch:
        n = len(docs)
        ids = [np.concatenate([d[1][k] for d in docs]) for k in (0, 1)]
        owner = [np.repeat(np.arange(n), [len(d[1][k]) for d in docs]) for k in (0, 1)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids, strict=True)]
        starts = [e - size[i] for e, size, i in zip(ends, self.sizes, ids, strict=True)]
        ga, gb = coalesce(starts[0], ends[0], starts[1], ends[1])
        a, b = overlaps(starts[0], ends[0], starts[1], ends[1])
        linked = ends[0][a] == ends[1][b]
        a, b = a[linked], b[linked]
        pairs, codes, counts = np.unique(ids[0][a].astype(np.int64) << 32 | ids[1][b], return_inverse=True, return_counts=True)
        opens = np.flatnonzero(np.diff(ga, prepend=-1))  # the first A token of each group
        # links and groups of each document, and its distinct pairs with how often each
        links = np.bincount(owner[0][a], minlength=n)
        own, times = np.unique(owner[0][a] * max(len(pairs), 1) + codes.reshape(-1), return_counts=True)
        offsets = np.searchsorted(own, np.arange(n + 1) * max(len(pairs), 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32))) for x in (own % max(len(pairs), 1), times)]
        counted = [np.bincount(owner[0], minlength=n), np.bincount(owner[1], minlength=n), np.bincount(owner[0][opens], minlength=n), links]
        nested = pa.StructArray.from_arrays(
            [pa.array([d[0] for d in docs], pa.int64()), *[pa.array(c.astype(np.int64)) for c in counted],
             pa.array(self.written_groups(ids, [ga, gb], owner, n), pa.string()), *lists],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "times"])
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), one(pa.array(pairs)), one(pa.array(counts.astype(np.int64))), one(nested)],
                                          ["chunk", "pairs", "counts", "docs"])


def align(docs: DataFrame, a_path: str, b_path: str, chunk: int | None = None) -> DataFrame:
    """Rows of chunks: ``chunk, pairs, counts, docs``, with ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order) in each of ``docs``.

    ``pairs`` are the chunk's distinct linked ids (A's in the high 32 bits) with how often each; a document names them
    by place (``codes``, ``times``). Texts null, empty, or not given back byte for byte by both sides have no tokens.
    Documents are rows: repeated ones are aligned each, a null doc_id stays null, more columns are ignored. No rows: no chunks.
    A text of any length is aligned whole; a document, and its chunk, have to fit in a task.
    """
    size = CHUNK if chunk is None else chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held, length = None, [], 0
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            aligner = aligner or Aligner(a_path, b_path)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if held and length + len(text or "") > size:
                    yield aligner.row(name, held)
                    name, held, length = name + 1, [], 0
                held.append((doc, aligner.tokens(text)))
                length += len(text or "")
        if held:
            yield aligner.row(name, held)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text") \
        .mapInArrow(run, f"chunk bigint, pairs array<bigint>, counts array<bigint>, docs array<{DOC}>")


def digested(chunks: DataFrame) -> DataFrame:
    """``chunks`` with the lowercase hex SHA-256 in place of ``groups``; without tokens it stays empty."""
    own = lambda d: d.withField("groups", F.when(d["groups"] == "", "").otherwise(F.sha2(d["groups"], 256)))
    return chunks.withColumn("docs", F.transform("docs", own))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, a, b, n, best``: how many links hold the ids linked, and whether that is the most of all pairs with this B id."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    total = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")) \
        .select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n")
    total = written(total, "pairs")
    most = total.groupBy("b").agg(F.max("n").alias("most"))
    return total.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(chunks: DataFrame) -> DataFrame:
    """A row for each document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``n_best``: links whose pair is the most frequent of its B id, ties included; ``count_sum``: the pairs' counts over the links.
    """
    chunks = written(chunks, "chunks")
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(pair_counts(chunks).select("pair", "n", "best"), "pair") \
        .groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("told"))

    def scored(d):
        each = F.arrays_zip(d["codes"], d["times"])
        pair = lambda x: F.get(F.col("told"), x["codes"])
        best = F.aggregate(each, F.lit(0).cast("bigint"), lambda s, x: s + F.when(pair(x)["best"], x["times"]).otherwise(0))
        total = F.aggregate(each, F.lit(0).cast("bigint"), lambda s, x: s + pair(x)["n"] * x["times"])
        return F.struct(*[d[c].alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                        best.alias("n_best"), total.alias("count_sum"), d["groups"].alias("groups"))

    return chunks.select("chunk", "docs").join(told, "chunk", "left") \
        .select(F.explode(F.transform("docs", scored)).alias("d")).select("d.*")

