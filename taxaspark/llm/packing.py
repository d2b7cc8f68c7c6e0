"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

The plan works on counts: pieces of one length are placed many at a time into
groups of sequences with one remaining capacity, longest first, always the
fullest sequences that still have room. It has at most ``capacity`` lengths as
input, whatever the corpus, and gives slots: (length, ranks from..to) go to
(sequence from.., offset). Documents then take their slots by rank
within length. Ranks are dealt in parts (length, salt), so that a length that
a third of all pieces share is ranked by many tasks.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import shuffle_partitions, written

# fixed values of the byte-level tokenizer format: how texts are cut into units, and which bytes stand for themselves
UNITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: tiktoken keeps a place on a stack of 1,000,000 for each character of a whitespace run, and panics beyond; far below that
SAFE_RUN = 100_000
SPACES = re.compile(r"\s+")  # Unicode whitespace: all that tiktoken's has, and U+001C to U+001F


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """The ranks of a byte-level BPE file whose ids follow the order of its merges; None for any other tokenizer."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or spec["normalizer"] or spec["post_processor"] or model.get("dropout") or model.get("unk_token") \
            or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges") \
            or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    other = iter(range(256))
    letters = {chr(b) if b in PLAIN else chr(256 + next(other)): b for b in range(256)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in pairs]
    if ids != sorted(ids) or len(model["vocab"]) != 256 + len(ids):
        return None
    return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}


class Encoder:
    """Ids (little-endian unsigned 32-bit) of whole texts, as the tokenizers library gives them for the file at ``path``.

    For byte-level BPE files the same merges are applied by tiktoken, which takes a fifth of the time and gives the same ids
    (``tests/llm`` compares every code point); other files, and texts that hold a special token or a whitespace run of more
    than ``SAFE_RUN`` characters, go to tokenizers itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast, ranks = None, byte_ranks(path)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("byte-level", pat_str=UNITS, mergeable_ranks=ranks, special_tokens={})

    def is_plain(self, text: str) -> bool:
        """Can tiktoken take it? The runs are looked at one by one (in linear time), and only in texts that may hold a long one."""
        if any(s in text for s in self.special):
            return False
        return len(text) <= SAFE_RUN or all(m.end() - m.start() <= SAFE_RUN for m in SPACES.finditer(text))

    def encode(self, text: str) -> bytes:
        if self.fast and self.is_plain(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids: whole ones, the first may be shorter."""
    head = total % capacity
    starts = [0] if head else []
    starts += range(head, total, capacity)
    return [(s, (head if s == 0 and head else capacity)) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (array<int>)."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                own = batch.slice(a, 64)
                rows = []
                for doc, text in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), strict=True):
                    ids = encoder.encode(text or "") + end
                    for i, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * s : 4 * (s + n)]
                        rows.append((doc, i, s, n, zlib.crc32(part)) + ((np.frombuffer(part, "<u4"),) if with_ids else ()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    kinds = [pa.field("doc_id", pa.int64()), pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
             pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())] + [pa.field("ids", pa.list_(pa.int32()))] * with_ids
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


@dataclass
class Plan:
    """Slots in order of (length, first rank): ranks first.. of a length go to sequences sequence.., at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def slots(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(self.length, length), np.searchsorted(self.length, length, "right")
        at = np.zeros(len(length), dtype=np.int64)
        for n in np.unique(length):
            own = length == n
            a, b = lo[own][0], hi[own][0]
            at[own] = a + np.searchsorted(self.first[a:b], rank[own], "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over counts. A group is (first sequence, number) of sequences with one remaining capacity.

    A step fills as many sequences of a group as the pieces that are left
    allow, so steps grow with the number of lengths and groups (each length
    adds a few groups at most), not with the number of pieces.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # by what remains
    remaining: list[int] = []  # sorted, of groups
    slots, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(remaining, room)
        groups[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(remaining, length)
            if at == len(remaining):  # no room anywhere: as many new sequences as the rest of this length needs
                n = -(-left // (capacity // length))
                put(capacity, sequences, n)
                sequences += n
                continue
            room = remaining[at]
            first, n = groups[room].pop()
            if not groups[room]:
                del groups[room]
                del remaining[at]
            # a sequence that has got one is now the fullest with room for the next: it takes as many as fit, or are left
            each = min(room // length, left)
            take = min(n, left // each)
            slots += [(length, rank + i * take, first, capacity - room + i * length) for i in range(each)]
            put(room - each * length, first, take)
            if n > take:
                put(room, first + take, n - take)
            rank, left = rank + each * take, left - each * take
    slots.sort()
    table = np.array(slots, dtype=np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequences)


def ranked(parts: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``parts`` with ``rank`` (from 0, within ``length``), and the histogram of lengths."""
    salts = shuffle_partitions(parts.sparkSession)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = written(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    # the pieces are in (length, salt) order already, so a merge join moves the small side only
    numbered = salted.withColumn("row", own).join(base.hint("merge"), ["length", "salt"])
    return numbered.withColumn("rank", F.col("base") + F.col("row") - 1).drop("salt", "row", "base"), counts


def pack(parts: DataFrame, capacity: int) -> DataFrame:
    """``parts`` (with doc_id, piece, length of at most ``capacity``) plus ``sequence_id`` and ``offset``."""
    numbered, counts = ranked(parts)
    plan = best_fit(counts, capacity)
    names = [*parts.columns, "sequence_id", "offset"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema], "sequence_id bigint, offset bigint"])
    at = len(parts.columns)
    place = parts.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seq, offset = plan.slots(batch.column(place).to_numpy(), batch.column(at).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(seq), pa.array(offset)], names)

    return numbered.select(*parts.columns, "rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    A document is the ids of its whole text (``tokenizer``: a byte-level file of the tokenizers library;
    null: empty) and then ``end_id``; only documents longer than ``capacity`` are cut, and their first piece may be
    shorter. Each sequence holds at most ``capacity`` ids without gaps. Repeated rows are documents of
    their own; a null doc_id stays null. No rows: no pieces.
    """
    parts = written(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return pack(parts, capacity)
