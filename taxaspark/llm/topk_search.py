"""Exact top-k by inner product with block-at-a-time pruning.

Rows are put in an order that brings like vectors together (sign pattern, then
id) and cut into document-range blocks. A block keeps a forward index (its
vectors) and the largest and smallest value of each term. For a query, the
sum over the terms of the larger of ``q * max`` and ``q * min`` bounds every score in the
block. A task takes a shard of blocks and a chunk of queries: it orders the blocks
by bound and scores them through the forward index until the bound falls below the k-th
score. The k-th score starts from what a first pass, over the shard that is likeliest to
hold the best rows, has found, so that most shards score few blocks.

Before anything is shuffled to be scored, each query's floor is held against the summed term maxima
of whole shards; only pairs of a query and a shard that reaches it are dealt, as (shard, chunk) groups of bounded size. Queries of
neighbouring shards make a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

BLOCK = 64  # vectors in a block
SHARD = 4096  # vectors in a shard, about
CHUNK = 1024  # queries in a chunk, about
SIGNS = 16  # terms of the sign pattern
#: shards and queries whose bounds a task compares
GROUP, ASKED = 1 << 15, 1 << 16


def whole_vectors(vectors: DataFrame, key: Column, vector: Column, scale: float) -> DataFrame:
    """``id, v``: floor(scale * x) of each component as bigint, values beyond 2 ** 62 held there. Vectors that are null or hold
    a null or non-finite component, and rows without id, are left out; equal rows are one."""
    x = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = F.lit(float(2**62))
    whole = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * scale, -most), most)))
    return vectors.where(vector.isNotNull() & key.isNotNull() & finite).select(key.cast("bigint").alias("id"), whole.alias("v")).distinct()


def blocks_of(rows: DataFrame, shards: int) -> DataFrame:
    """``shard, ids, dims, mat, high, low``, a row for each block: shards are ranges of (sign pattern, id), blocks follow in them."""
    pattern = F.aggregate(F.slice("v", 1, SIGNS), F.lit(0), lambda a, x: a * 2 + (x >= 0).cast("int"))
    schema = "ids array<bigint>, dims int, mat binary, high binary, low binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

        def block(ids: list, rows_: list) -> tuple:
            dims = max(len(r) for r in rows_)
            mat = np.zeros((len(rows_), dims), dtype=np.int64)  # a term that a vector lacks is 0
            for i, r in enumerate(rows_):
                mat[i, : len(r)] = r
            return ids, dims, mat.tobytes(), mat.max(axis=0).tobytes(), mat.min(axis=0).tobytes()

        held_ids, held_rows, more = [], [], True
        while more:
            batch = next(batches, None)
            more = batch is not None
            if more:
                held_ids += batch.column(0).to_pylist()
                held_rows += [x.values.to_numpy() for x in batch.column(1)]
            made = []
            while len(held_ids) >= BLOCK or held_ids and not more:
                made.append(block(held_ids[:BLOCK], held_rows[:BLOCK]))
                held_ids, held_rows = held_ids[BLOCK:], held_rows[BLOCK:]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)],
                                                 ["ids", "dims", "mat", "high", "low"])

    ordered = rows.withColumn("pattern", pattern).repartitionByRange(shards, "pattern", "id").sortWithinPartitions("pattern", "id")
    return ordered.select("id", "v").mapInArrow(run, schema).withColumn("shard", F.spark_partition_id())


def product(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """q @ m.T in whole numbers: by floating point where that is exact, else by 64 bits, else by Python's integers."""
    d = min(q.shape[1], m.shape[1])
    q, m = q[:, :d], m[:, :d]
    most = (int(np.abs(q).max(initial=0)) * int(np.abs(m).max(initial=0))) * max(d, 1)
    if most < 2**53:
        return (q.astype(np.float64) @ m.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return q @ m.T
    exact = q.astype(object) @ m.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The summed term maxima: (queries, blocks). In floating point, rounded up."""
    d = min(q.shape[1], high.shape[1])
    f = q[:, :d].astype(np.float64)
    up, down = np.maximum(f, 0), np.minimum(f, 0)
    total = up @ high[:, :d].astype(np.float64).T + down @ low[:, :d].astype(np.float64).T
    size = up @ np.abs(high[:, :d]).astype(np.float64).T - down @ np.abs(low[:, :d]).astype(np.float64).T
    return total + size * 1e-12


class Best:
    """The k best (score, id) of each query so far; ties to the smaller id."""

    def __init__(self, n: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least  # least: a score that k rows reach, known from before
        self.score = [np.empty(0, np.int64)] * n
        self.id = [np.empty(0, np.int64)] * n

    def floor(self, i: int) -> int:
        own = int(self.score[i][-1]) if len(self.score[i]) == self.k else -(2**63)
        return max(own, int(self.least[i]))

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        some = score >= self.floor(i)
        if not some.any():
            return
        s, d = np.concatenate([self.score[i], score[some]]), np.concatenate([self.id[i], ids[some]])
        order = np.lexsort([d, -s] if s.min() > -(2**63) else [d, [-int(x) for x in s]])[: self.k]
        self.score[i], self.id[i] = s[order], d[order]


def search_shard(q_id: np.ndarray, q: np.ndarray, least: np.ndarray, ids: list, mats: list, high: np.ndarray, low: np.ndarray,
                 k: int) -> Best:
    """Block at a time: each query takes the blocks in the order of their bounds, until they fall below its k-th score."""
    best = Best(len(q), k, least)
    bound = bounds(q, high, low)
    order = np.argsort(-bound, axis=1, kind="stable")
    active = np.arange(len(q))
    for step in range(len(mats)):
        nth = order[active, step]
        floor = np.array([best.floor(i) for i in active], dtype=np.float64)
        going = bound[active, nth] >= floor  # equal: a smaller id may still win
        active, nth = active[going], nth[going]
        if not len(active):
            break
        for b in np.unique(nth):  # all queries that take this block now, at once
            own = active[nth == b]
            score = product(q[own], mats[b])
            for i, s in zip(own, score, strict=True):
                other = ids[b] != q_id[i]
                best.add(i, s[other], ids[b][other])
    return best


def matrix(raw: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64).reshape(-1, dims) if dims else np.zeros((1, 0), np.int64)


def search_pairs(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, id, score``: up to k rows for each query and shard; both sides have ``shard, chunk``."""

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        if own.num_rows and asked.num_rows:
            dims = own.column("dims").to_pylist()
            mats, high, low = ([np.frombuffer(r, dtype=np.int64).reshape(-1, d) if d else np.zeros((n, 0), np.int64)
                                for r, d, n in zip(own.column(c).to_pylist(), dims, sizes, strict=True)]
                               for c, sizes in (("mat", pa.compute.list_value_length(own.column("ids")).to_pylist()),
                                                ("high", [1] * len(dims)), ("low", [1] * len(dims))))
            high, low = (np.vstack([np.pad(m, ((0, 0), (0, max(dims) - m.shape[1]))) for m in side]) for side in (high, low))
            ids = [np.asarray(x, dtype=np.int64) for x in own.column("ids").to_pylist()]
            vs = [np.asarray(x, dtype=np.int64) for x in asked.column("v").to_pylist()]
            q = np.zeros((len(vs), max(len(v) for v in vs)), dtype=np.int64)
            for i, v in enumerate(vs):
                q[i, : len(v)] = v
            q_id = asked.column("id").to_numpy()
            best = search_shard(q_id, q, asked.column("least").to_numpy(), ids, mats, high, low, k)
            out = [np.repeat(q_id, [len(x) for x in best.id]), np.concatenate(best.id), np.concatenate(best.score)]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "id", "score"), out, strict=True)})

    return blocks.groupBy("shard", "chunk").cogroup(queries.groupBy("shard", "chunk")).applyInArrow(
        run, "query_id bigint, id bigint, score bigint")


def shard_boxes(blocks: DataFrame) -> DataFrame:
    """``shard, high, low``: the term maxima and minima of each shard (as arrays, a missing term is 0)."""

    def run(own: pa.Table) -> pa.Table:
        dims = own.column("dims").to_pylist()
        sides = []
        for name, most in (("high", np.max), ("low", np.min)):
            rows = [np.pad(np.frombuffer(r, dtype=np.int64), (0, max(dims) - d)) for r, d in zip(own.column(name).to_pylist(), dims, strict=True)]
            sides.append(most(np.vstack(rows), axis=0))
        return pa.table({"shard": own.column("shard").slice(0, 1), "high": pa.array([sides[0]], pa.list_(pa.int64())), "low": pa.array([sides[1]], pa.list_(pa.int64()))})

    return blocks.select("shard", "dims", "high", "low").groupBy("shard").applyInArrow(run, "shard int, high array<bigint>, low array<bigint>")


def padded(rows: list) -> np.ndarray:
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def reachable(blocks: DataFrame, asked: DataFrame, shards: int, n_queries: int) -> DataFrame:
    """``id, shard``: the shards whose summed term maxima reach a query's floor, for every row of ``asked`` (id, v, least).

    Only these pairs are shuffled with vectors and blocks. Here a query goes to one row for each ``GROUP`` shards, and a shard's
    box to one for each ``ASKED`` queries.
    """
    groups, parts = max(1, -(-shards // GROUP)), max(1, -(-n_queries // ASKED))

    def run(own: pa.Table, wanted: pa.Table) -> pa.Table:
        ids, at = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        if own.num_rows and wanted.num_rows:
            shard = own.column("shard").to_numpy()
            high, low = padded(own.column("high").to_pylist()), padded(own.column("low").to_pylist())
            q, least, q_id = padded(wanted.column("v").to_pylist()), wanted.column("least").to_numpy(), wanted.column("id").to_numpy()
            for a in range(0, len(q), 256):
                near = bounds(q[a : a + 256], high, low) >= least[a : a + 256, None].astype(np.float64)  # equal: a smaller id may win
                i, j = np.nonzero(near)
                ids.append(q_id[a + i])
                at.append(shard[j])
        return pa.table({"id": pa.array(np.concatenate(ids), pa.int64()), "shard": pa.array(np.concatenate(at), pa.int32())})

    boxes = shard_boxes(blocks).withColumn("g", F.floor(F.col("shard") / GROUP).cast("int")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    spread = asked.select("id", "v", "least").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")) \
        .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return boxes.groupBy("g", "part").cogroup(spread.groupBy("g", "part")).applyInArrow(run, "id bigint, shard int").distinct()


def best_rows(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, key: str, vector: str, is_query: Column, k: int, scale: float = 256.0) -> DataFrame:
    """``query_id, rank, id, score``: the k rows with the largest inner products for each query row, its own id left out.

    ``is_query`` is a condition on ``id``. All rows are candidates. Components are floor(scale * x). A term that one of two
    vectors lacks counts as 0. Ties go to the smaller id; fewer than k other rows: all. Rows without id or with a null,
    null-holding or non-finite vector take no part. Rows of one id are one another's own, and count once, with the
    best of their scores. No rows: no result.
    """
    rows = written(whole_vectors(vectors, F.col(key), F.col(vector), scale), "vectors")
    blocks = written(blocks_of(rows, max(1, -(-rows.count() // SHARD))), "blocks")
    shards = (blocks.agg(F.max("shard")).first()[0] or 0) + 1
    queries = rows.where(is_query)
    chunks = max(1, -(-queries.count() // CHUNK))
    # first each query in its own shard, where its like are: their k-th score is a floor for all other shards
    home = blocks.select(F.col("shard").alias("home"), F.explode("ids").alias("id")).distinct()
    lowest = F.lit(-(2**63)).cast("bigint")
    near = search_pairs(blocks.withColumn("chunk", F.lit(0)),
                        queries.join(home, "id").select("id", "v", F.col("home").alias("shard"), F.lit(0).alias("chunk"),
                                                        lowest.alias("least")), k)
    floors = written(best_rows(near, k).groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(lowest).alias("least")), "floors")
    # queries of neighbouring shards are alike: they make a chunk, as they look in the same shards
    place = home.groupBy("id").agg(F.floor(F.min("home") * chunks / shards).cast("bigint").alias("chunk"))
    asked = written(queries.join(floors, "id", "left").join(place, "id").select("id", "v", F.coalesce("least", lowest).alias("least"), "chunk"), "queries")
    # then the pairs of a shard and a query whose bound reaches the query's floor
    pairs = written(reachable(blocks, asked, shards, asked.count()), "pairs")
    spread = asked.join(pairs, "id")
    dealt = blocks.join(written(spread.select("shard", "chunk").distinct(), "dealt"), "shard")
    return best_rows(search_pairs(dealt, spread, k), k).select("query_id", "rank", "id", "score")
