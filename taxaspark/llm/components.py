"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written

#: edges that a task contracts at once
CHUNK = 1 << 20


def contracted(edges: DataFrame) -> DataFrame:
    """``edges`` (u < v) with each task's share, in chunks, as stars around the smallest node: the same components, fewer and shorter ways."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        def stars() -> pa.RecordBatch:
            pairs = [(root(x), x) for x in list(parent)]
            pairs = [p for p in pairs if p[0] != p[1]]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])

        taken = 0
        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                parent[max(a, b)] = min(a, b)
            taken += batch.num_rows
            if taken >= CHUNK:
                yield stars()
                parent.clear()
                taken = 0
        if parent:
            yield stars()

    return edges.mapInArrow(run, "u bigint, v bigint")


def settled(edges: DataFrame) -> bool:
    """Is every node of ``edges`` (u < v) either a centre or at the end of one edge?"""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(0).alias("low")),
                                          F.struct(F.col("v").alias("node"), F.lit(1).alias("low")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("low").alias("low"), F.min("low").alias("centre")) \
        .where("low > 1 OR (low = 1 AND centre = 0)").isEmpty()


def components(edges: DataFrame, contract: bool = True) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (``u, v``).

    Each round links every larger neighbour of a node to its smallest one (large star), then every node and its smaller
    neighbours to the smallest of these (small star). Ways halve about, so the rounds grow with the logarithm of the longest: 11 for a chain
    of 2,000 nodes in ascending, descending or any other order (``tests/llm`` counts them). Between rounds each
    task turns its share of the edges into stars (``contract``), which most often leaves one round or two.
    Only the smallest neighbour of each node is aggregated, and tables joined by a node with very many edges are written, so Spark can split them.
    Null ends, loops and repeated edges have no effect; no edges: no rows.
    """
    tidy = (lambda e: contracted(e)) if contract else (lambda e: e)
    edges = written(tidy(edges.where("u <> v").select(F.least("u", "v").cast("bigint").alias("u"),
                                                      F.greatest("u", "v").cast("bigint").alias("v")).distinct()), "edges")
    while not settled(edges):
        both = edges.union(edges.select("v", "u"))
        low = written(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "lowest")
        large = edges.join(low, "u").select(F.col("low").alias("u"), "v")
        least = written(large.groupBy("v").agg(F.min("u").alias("m")), "lowest")
        ends = F.explode(F.array(F.col("v"), F.col("u"))).alias("v")
        small = large.join(least, "v").select(F.col("m").alias("u"), ends).where("u <> v").distinct()
        edges = written(tidy(small), "edges")
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(edges.select("u", "u").distinct())
