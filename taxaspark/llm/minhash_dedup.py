"""Near-duplicate documents by b-bit MinHash.

1. Each document becomes the set of its distinct word shingles (64-bit hashes),
   and that a print of the set, ``bands * rows`` minima, one key for each band of
   minima, and the packed low bits of all minima. Documents with one set are
   represented by their smallest doc_id from here on.
2. Band keys that two sets or more share are candidate buckets. Within a bucket,
   the packed bits are compared by bit counts; the share of equal values,
   corrected for chance collisions, estimates the similarity. Pairs far below the
   threshold go (``sigmas`` standard errors); of the rest a spanning forest is kept,
   never all pairs. The components of all forests are families: a link can
   only be within one.
3. Within a family, links are confirmed on the full sets, again as a forest: a
   set that has been reached is compared with those not yet reached. Large
   buckets and families are cut into blocks, and each pair of blocks is a task's work of
   bounded size, so that no link is lost and no group goes to one task.
4. Components of the confirmed links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import text_print, written
from .words import U, Hasher, fixed_binary, grouped, lists, mix, ngrams, randoms, text_chunks

BLOCK = 1024  # sets of a large family in a block, at most
SMALL_BLOCK = 64  # sets of a family of up to 32 blocks in a block
BLOCK_SHINGLES = 1 << 20  # shingles of a block, as a mean
BUCKET_BLOCK = 4096  # signatures of a bucket in a block


def shingle_sets(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a chunk."""
    _, _, h, first = hasher.words(data, offsets)
    grams = ngrams(h, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:  # fewer words: the whole sequence is one shingle
            yield ngrams(h[a:b], b - a, seed=100 + b - a)
        else:
            yield h[:0]


class Signer:
    def __init__(self, bands: int, rows: int, bits: int, seed: int = 7) -> None:
        k = bands * rows
        self.bands, self.rows, self.bits = bands, rows, bits
        self.a = (randoms(k, seed) | U(1))[None, :]
        self.b = randoms(k, seed + 1)[None, :]
        self.row = randoms(rows, seed + 2) | U(1)
        self.band = randoms(bands, seed + 3)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(self.a.shape[1], 2**64 - 1, dtype=U)
        for i in range(0, len(shingles), 256):  # stays in the cache
            x = shingles[i : i + 256, None] * self.a
            x += self.b
            np.minimum(low, x.min(axis=0), out=low)
        return low

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A key for each band, from a matrix with a line for each document."""
        m = minima.reshape(len(minima), self.bands, self.rows)
        return mix((mix(m) * self.row).sum(axis=2, dtype=U) + self.band)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        low = (mix(minima) & U((1 << self.bits) - 1)).astype(np.uint8)
        planes = ((low[:, :, None] >> np.arange(self.bits, dtype=np.uint8)) & 1).reshape(len(low), -1)
        packed = np.packbits(planes, axis=1)
        return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))


def equal_values(a: np.ndarray, b: np.ndarray, bits: int, k: int) -> np.ndarray:
    """How many of the k b-bit values agree; lines of a and b are packed signatures as uint64."""
    x = a ^ b
    if bits == 1:
        differ = x
    elif bits == 2:
        differ = (x | (x >> U(1))) & U(0x5555555555555555)
    else:
        raise ValueError("bits: 1 or 2")
    return k - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64)


def least_equal(threshold: float, bits: int, k: int, sigmas: float) -> int:
    """Fewer agreeing values than this: the corrected estimate is ``sigmas`` standard errors below the threshold."""
    chance = 2.0**-bits
    p = chance + (1 - chance) * threshold  # two values agree if the minima do, or by chance
    return int(np.floor(k * p - sigmas * np.sqrt(k * p * (1 - p))))


def signatures(docs: DataFrame, n: int, lower: bool, bands: int, rows: int, bits: int) -> DataFrame:
    """``doc_id, fp, n_shingles, set_key, bands, sig``; without words set_key and what follows are null."""
    schema = "doc_id bigint, fp bigint, n_shingles bigint, set_key binary, bands array<bigint>, sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, signer = Hasher(lower), Signer(bands, rows, bits)
        names = ["doc_id", "fp", "n_shingles", "set_key", "bands", "sig"]
        with np.errstate(over="ignore"):
            for batch in batches:
                for a, b, data, offsets in text_chunks(batch.column(2)):
                    low, sizes, prints = np.zeros((b - a, bands * rows), dtype=U), [], []
                    for i, s in enumerate(shingle_sets(hasher, data, offsets, n)):
                        sizes.append(len(s))
                        prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                        if len(s):
                            low[i] = signer.minima(s)
                    keys = signer.keys(low)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(sizes, pa.int64()),
                         pa.array(prints, pa.binary()),
                         lists(keys.view(np.int64).ravel(), np.full(b - a, bands), pa.int64()),
                         fixed_binary(signer.packed(low))], names)

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_print(F.col("text")).alias("fp"), "text")
    return own.mapInArrow(run, schema)


def paired(rows: DataFrame, keys: list[str], blocks: Column, own: Column) -> DataFrame:
    """Each row of a group of ``blocks`` blocks, once for each pair of blocks (``bi < bj``) that has its own; with one block, once."""
    mine = F.pmod(F.xxhash64(own), F.col("_n")).cast("int")
    other = F.explode(F.when(F.col("_n") == 1, F.array(F.lit(-1))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda x: x != F.col("_mine"))))
    return rows.withColumn("_n", blocks.cast("int")).withColumn("_mine", mine).withColumn("_other", other) \
        .withColumn("bi", F.least("_mine", "_other")).withColumn("bj", F.greatest("_mine", "_other")) \
        .drop("_n", "_mine", "_other")


def spread(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups together, in order, in as many partitions as shuffles have."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def forest(n: int, near) -> Iterator[tuple[int, int]]:
    """Edges (reached, new) of a spanning forest; near(i, rest) tells which of ``rest`` are linked with i."""
    rest = np.arange(n)
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            if hit.any():
                found = rest[hit].tolist()
                yield from ((i, j) for j in found)
                queue += found
                rest = rest[~hit]


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def candidate_edges(members: DataFrame, bits: int, k: int, threshold: float, sigmas: float) -> DataFrame:
    """Forest edges ``u, v`` of each bucket by the packed signatures; members: key, bi, bj, node, n, sig."""
    least = least_equal(threshold, bits, k, sigmas)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in grouped(batches, ["key", "bi", "bj"]):
            node, size = table.column("node").to_numpy(), table.column("n").to_numpy().astype(float)
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=U).reshape(len(node), -1)

            def like(i, rest):
                fits = np.minimum(size[i], size[rest]) >= threshold * np.maximum(size[i], size[rest]) - 1e-9
                return fits & (equal_values(sig[rest], sig[i], bits, k) >= least)  # noqa: B023

            start = np.repeat(cuts[:-1], np.diff(cuts))
            hit = np.zeros(len(node), dtype=bool)
            every = np.arange(len(node))
            hit = like(start, every) & (every != start)  # all with the first of their bucket, at once
            u, v = [node[start[hit]]], [node[hit]]
            alone = np.add.reduceat((~hit).astype(np.int64), cuts[:-1]) > 1
            for a, b in zip(cuts[:-1][alone].tolist(), cuts[1:][alone].tolist(), strict=True):
                if b - a > 2:
                    e = np.array(list(forest(b - a, lambda i, rest: like(a + i, a + rest))), dtype=np.int64)  # noqa: B023
                    if len(e):
                        u.append(node[a + e[:, 0]])
                        v.append(node[a + e[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], schema=EDGES)

    return spread(members.select("key", "bi", "bj", "node", "n", "sig"), ["key", "bi", "bj"]).mapInArrow(
        run, "u bigint, v bigint")


def confirmed_edges(members: DataFrame, percent: int) -> DataFrame:
    """Forest edges of each family on the full sets: 100 * intersection >= percent * union; members: family, bi, bj, node, shingles."""

    def links(node: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> Iterator[tuple[int, int]]:
        _, ids = np.unique(flat, return_inverse=True)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(int(ids.max()) + 1, dtype=np.int64)
        fits = lambda i, rest: 100 * np.minimum(sizes[i], sizes[rest]) >= percent * np.maximum(sizes[i], sizes[rest])

        def near(i: int, rest: np.ndarray) -> np.ndarray:
            out, some = np.zeros(len(rest), dtype=bool), np.flatnonzero(fits(i, rest))
            if len(some):
                mark[ids[offsets[i] : offsets[i + 1]]] = 1
                if len(some) * 4 > len(sizes):  # nearly all: one pass over everything
                    both = np.add.reduceat(mark[ids], offsets[:-1])[rest[some]]
                else:
                    both = np.array([mark[ids[offsets[j] : offsets[j + 1]]].sum() for j in rest[some]])
                mark[ids[offsets[i] : offsets[i + 1]]] = 0
                out[some] = 100 * both >= percent * (sizes[i] + sizes[rest[some]] - both)
            return out

        return forest(len(node), near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in grouped(batches, ["family", "bi", "bj"]):
            u, v = [], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = table.slice(a, b - a).combine_chunks()
                node = own.column("node").to_numpy()
                shingles = own.column("shingles").combine_chunks()
                sizes = np.diff(shingles.offsets.to_numpy()).astype(np.int64)
                for i, j in links(node, sizes, shingles.flatten().to_numpy()):
                    u.append(node[i])
                    v.append(node[j])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=EDGES)

    return spread(members.select("family", "bi", "bj", "node", "shingles"), ["family", "bi", "bj"]).mapInArrow(
        run, "u bigint, v bigint")


def full_sets(docs: DataFrame, nodes: DataFrame, n: int, lower: bool) -> DataFrame:
    """``family, blocks, node, shingles`` of the documents in ``nodes`` (node, fp, family, blocks)."""
    schema = "family bigint, blocks int, node bigint, shingles array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower)
        with np.errstate(over="ignore"):
            for batch in batches:
                for a, b, data, offsets in text_chunks(batch.column(3)):
                    sets = list(shingle_sets(hasher, data, offsets, n))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(i).slice(a, b - a) for i in range(3)]
                        + [lists(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]), pa.int64())],
                        ["family", "blocks", "node", "shingles"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("node"), text_print(F.col("text")).alias("fp"), "text")
    return own.join(nodes, ["node", "fp"]).select("family", "blocks", "node", "text").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, lower: bool = True, bands: int = 32, rows: int = 5,
                    bits: int = 2, sigmas: float = 5.0) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, fp, n_shingles, component_id, kept``.

    Words ``[^\\x20\\x09-\\x0D]+`` (A-Z in lower case if ``lower``); a set of the
    distinct ``n``-word shingles; fewer words: the whole sequence is the one shingle;
    no words or no text: empty and linked with nothing. Two documents are linked if
    100 * intersection >= percent * union. component_id: the smallest doc_id
    reachable; kept: it is the document's own. A pair just at 80 % stays
    unseen with probability (1 - 0.8 ** rows) ** bands = 3e-6, or 3e-7 for the estimate.
    Rows of one doc_id and equal sets share their result; rows of one doc_id and
    different sets are one node. Null doc_id: no links, component_id null, kept.
    """
    k = bands * rows
    signed = written(signatures(docs, n, lower, bands, rows, bits), "signatures")
    reps = written(signed.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "fp")).alias("own"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig"))
        .select("set_key", F.col("own.doc_id").alias("node"), F.col("own.fp").alias("fp"), "n", "bands", "sig"),
        "representatives")
    keyed = reps.select("node", "n", F.explode("bands").alias("key"))
    # tables that are joined by a key that may be hot are written: Spark can then split the other side's partition
    counted = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "shared-keys")
    shared = keyed.join(counted, "key")
    bucket = paired(shared, ["key"], F.ceil(F.col("rows") / BUCKET_BLOCK), F.col("node"))
    members = bucket.join(reps.select("node", "sig"), "node")
    families = components(candidate_edges(members, bits, k, percent / 100, sigmas)) \
        .select("node", F.col("component").alias("family"))
    inside = written(families.join(reps.select("node", "fp", "n"), "node"), "families")
    by_count = F.least(F.ceil(F.col("c") / SMALL_BLOCK), 32 + F.ceil(F.col("c") / BLOCK))
    sizes = written(inside.groupBy("family").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).select(
        "family", F.greatest(by_count, F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "family-sizes")
    nodes = inside.join(sizes, "family").select("node", "fp", "family", "blocks")
    blocks = paired(full_sets(docs, nodes, n, lower), ["family"], F.col("blocks"), F.col("node"))
    classes = components(confirmed_edges(blocks, percent))
    own = reps.select("set_key", F.col("node").alias("rep")).join(
        classes.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .select("set_key", F.coalesce("component", "rep").alias("component"))
    found = signed.select("doc_id", "fp", "n_shingles", "set_key").join(own, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "fp", "n_shingles", component.alias("component_id"),
                        component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that a smaller doc_id of their component stands for.

    Columns pass through. Repeated rows (equal doc_id and text): all stay or go together.
    """
    gone = near_duplicates(docs, **options).where(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).distinct()
    own = docs.withColumn("_print", text_print(F.col("text")))
    left = own.join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("_print") == F.col("_fp")), "left_anti")
    return left.select(*docs.columns)
