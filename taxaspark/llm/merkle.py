"""A Merkle manifest of a table by time-forward processing.

Leaves stand in order within their group; every 8 consecutive nodes (the last
run: fewer, even one) become the digest of their digests, until one node, the
group's subroot, is left. The subroots in order of their groups likewise give
the root.

Nodes are labelled (last leaf below, level), so a parent comes right after its
last child. In time-forward order a node sends its digest to its parent
through a priority queue ordered by label, and a parent takes its children's
digests from the front of the queue when its time comes. A sweep in reversed order starts
at the root: each node sends the proof suffix (siblings from there up to the
root) to its children.

The queue is external: labels are cut into blocks of ``8 ** LEVELS`` leaves. Within
a block a heap is enough (a few messages for each level); what crosses blocks
is written and sorted by Spark by (group, block, place), with the messages of
later blocks ahead of the nodes that receive them. So each round divides the nodes by
4,096, no task holds more than some blocks, whatever the size of a group, and a lost executor costs the running round.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import shuffle_partitions, written

ARITY = 8
#: levels of the tree that one round climbs: a block holds ARITY ** LEVELS nodes
LEVELS = 4

STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


def framed(column: Column | str) -> Column:
    """``-`` if null, else the number of UTF-8 bytes, ``:`` and the value (numbers in decimal)."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column | str) -> Column:
    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def sweep_up(leaves: Sequence[str], levels: int) -> list[list[str]]:
    """The digests of a block, level by level, in time-forward order."""
    nodes: list[list[str]] = [[] for _ in range(levels + 1)]
    queue: list[tuple[int, int, int, str]] = []  # (last leaf and level of the receiver, sender's place, digest)
    last = len(leaves) - 1

    def arrive(level: int, place: int, digest: str) -> None:
        nodes[level].append(digest)
        if level < levels:
            end = min((place // ARITY + 1) * ARITY ** (level + 1) - 1, last)
            heapq.heappush(queue, (end, level + 1, place, digest))

    for now, leaf in enumerate(leaves):
        arrive(0, now, leaf)
        while queue and queue[0][0] == now:
            level, place, parts = queue[0][1], queue[0][2] // ARITY, []
            while queue and queue[0][:2] == (now, level):
                parts.append(heapq.heappop(queue)[3])
            arrive(level, place, digest_of("".join(parts)))
    return nodes


def sweep_down(nodes: list[list[str]], suffix: tuple | None) -> Iterator[tuple[int, tuple | None]]:
    """(place, proof) of every leaf of a block, the last leaf first.

    A proof is a chain: ((siblings before, siblings after), rest of the proof) or None;
    ``suffix`` is that of the block's top node.
    """
    last = len(nodes[0]) - 1
    queue: list[tuple[int, int, int, tuple | None]] = [(-last, -(len(nodes) - 1), 0, suffix)]
    while queue:
        _, level, place, proof = heapq.heappop(queue)
        level = -level
        if not level:
            yield place, proof
            continue
        run = nodes[level - 1][place * ARITY : (place + 1) * ARITY]
        for i in range(len(run)):
            child = place * ARITY + i
            end = min((child + 1) * ARITY ** (level - 1) - 1, last)
            heapq.heappush(queue, (-end, 1 - level, child, (("".join(run[:i]), "".join(run[i + 1 :])), proof)))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block: runs of equal values in the first two columns."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        g, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((g[1:] != g[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *edges], [*edges, len(g)], strict=True):
            own = (g[lo], block[lo])
            if own != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def by_block(nodes: DataFrame) -> DataFrame:
    """One task for a block, its rows by place."""
    n = shuffle_partitions(nodes.sparkSession)
    return nodes.repartition(n, "g", "block").sortWithinPartitions("g", "block", "place")


def placed(rows: DataFrame, group: str, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` plus ``place`` (from 0) within ``group`` and ``n``, the size of the group; and a row for each group.

    One shuffle by ranges; a group may spread over all of them. Totals for each (group, range) are added up, no rows.
    """
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), group, *order) \
        .sortWithinPartitions(group, *order).withColumn("at", F.monotonically_increasing_id())
    ranged = written(ranged, name).withColumn("part", F.shiftright("at", 33))
    parts = written(ranged.groupBy(group, "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n")), name + "-parts")
    ahead = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = parts.groupBy(group).agg(F.sum("n").alias("n"))
    base = parts.select(F.col(group).alias("own"), F.col("part").alias("own_part"), "low",
                        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    whole = groups.select(F.col(group).alias("whole"), F.col("n"))
    found = ranged.join(base, F.col(group).eqNullSafe(F.col("own")) & (F.col("part") == F.col("own_part"))) \
        .join(whole, F.col(group).eqNullSafe(F.col("whole")))
    return found.withColumn("place", F.col("base") + F.col("at") - F.col("low")) \
        .drop("at", "part", "own", "own_part", "low", "base", "whole"), groups


def climb(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All rounds from ``nodes`` (``g, n, place, digest``, more columns are kept) to one node a group.

    Returns the nodes of each round, with their block, and the top of each group: ``g, digest, round``.
    """
    size = ARITY**levels

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches):
            n = block.column("n")[0].as_py()
            top = sweep_up(block.column("digest").to_pylist(), min(levels, height(n)))[-1]
            yield pa.RecordBatch.from_pydict({"g": [block.column(0)[0].as_py()], "n": [-(-n // size)],
                                              "place": [block.column(1)[0].as_py()], "digest": top},
                                             schema=pa.schema([("g", pa.int64()), ("n", pa.int64()), ("place", pa.int64()),
                                                               ("digest", pa.string())]))

    rounds, tops = [], None
    blocked = F.floor(F.col("place") / size).cast("bigint").alias("block")
    while True:
        nodes = nodes.select("g", blocked, *[c for c in nodes.columns if c != "g"])
        rounds.append(nodes)
        above = written(by_block(nodes.select("g", "block", "place", "n", "digest"))
                        .mapInArrow(up, "g bigint, n bigint, place bigint, digest string"), name)
        top = above.where("n = 1").select("g", "digest", F.lit(len(rounds) - 1).alias("round"))
        tops = top if tops is None else tops.unionByName(top)
        nodes = above.where("n > 1")
        if nodes.isEmpty():
            return rounds, tops


def descend(rounds: list[DataFrame], tops: DataFrame, levels: int, name: str) -> DataFrame:
    """The first round's nodes with ``proof, subroot, root``.

    ``tops``: ``g, round, proof, subroot, root`` for the top of each group, the first messages of the reversed sweep.
    """
    kinds = "proof array<struct<before:string,after:string>>, subroot string, root string"

    def down(keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in runs(batches):
                said, own = block.slice(0, 1), block.slice(1)  # the message stands at place -1
                suffix = None
                for step in reversed(said.column("proof")[0].as_py()):
                    suffix = ((step["before"], step["after"]), suffix)
                nodes = sweep_up(own.column("digest").to_pylist(), min(levels, height(own.column("n")[0].as_py())))
                before, after, ends = [], [], [0]
                for _, proof in sorted(sweep_down(nodes, suffix), key=lambda x: x[0]):
                    while proof:
                        (b, a), proof = proof
                        before.append(b)
                        after.append(a)
                    ends.append(len(before))
                steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(STEP))
                both = [pa.array([said.column(c)[0].as_py()] * own.num_rows, pa.string()) for c in ("subroot", "root")]
                first = {c: own.column(c).combine_chunks() for c in (["row"] if keep else ["g", "place"])}
                yield pa.RecordBatch.from_arrays([*first.values(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps), *both],
                                                 [*first, "proof", "subroot", "root"])
        return run

    messages = None
    for k in reversed(range(len(rounds))):
        start = tops.where(F.col("round") == k).select("g", F.lit(0).cast("bigint").alias("block"), "proof", "subroot", "root")
        messages = start if messages is None else messages.unionByName(start)
        nodes = rounds[k]
        if k:
            nodes = nodes.select("g", "block", "place", "n", "digest")
        both = by_block(nodes.unionByName(messages.withColumn("place", F.lit(-1).cast("bigint")), allowMissingColumns=True))
        if not k:
            row = both.schema["row"].dataType.simpleString()
            return both.mapInArrow(down(True), f"row {row}, {kinds}")
        messages = written(both.mapInArrow(down(False), f"g bigint, place bigint, {kinds}"), name) \
            .withColumnRenamed("place", "block")


def manifest(leaves: DataFrame, group: str, order: Sequence[str], digest: str, levels: int | None = None) -> DataFrame:
    """``leaves`` plus ``subroot``, ``root`` and ``proof``: array of (before, after), from the leaf up to the root.

    ``before`` and ``after`` are the digests of the run's other nodes left and right of the one on the way, joined.
    ``digest`` names the leaf's digest (lowercase hex). Groups stand in order of ``group`` (null first, bytewise),
    leaves in ``order`` (nulls first), which should tell leaves of unlike digests apart: put the digest last.
    Repeated rows are leaves of their own; a null group is a group. Of columns named ``subroot``, ``root`` or ``proof``
    the tree's replace those of ``leaves``. All columns of ``leaves`` are shuffled, so leave texts out. No rows: no rows.
    """
    levels = LEVELS if levels is None else levels
    own = [c for c in leaves.columns if c not in ("subroot", "root", "proof")]
    rows = leaves.select(F.col(group).alias("grp"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                         F.col(digest).alias("digest"), F.struct(*own).alias("row"))
    rows, groups = placed(rows, "grp", [f"o{i}" for i in range(len(order))], "leaves")
    groups, _ = placed(groups.select(F.lit(0).alias("one"), F.col("grp").alias("of")), "one", ["of"], "groups")
    groups = written(groups.select("of", F.col("place").alias("g"), F.col("n").alias("n_groups")), "groups")
    nodes = rows.join(groups, F.col("grp").eqNullSafe(F.col("of"))).select("g", "n", "place", "digest", "row")
    rounds, tops = climb(written(nodes, "nodes"), levels, "nodes")

    subroots = tops.join(groups, "g").select(F.lit(0).cast("bigint").alias("g"), F.col("n_groups").alias("n"), F.col("g").alias("place"),
                                             "digest", F.struct("g", "round", F.col("digest").alias("subroot")).alias("row"))
    above, root = climb(written(subroots, "subroots"), levels, "groups")
    none = F.array().cast("array<struct<before:string,after:string>>")
    start = root.select("g", "round", none.alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    found = written(descend(above, start, levels, "suffixes"), "suffixes")
    tops = found.select("row.g", "row.round", "proof", "row.subroot", "root")
    return descend(rounds, tops, levels, "suffixes").select("row.*", "subroot", "root", "proof")


def siblings(proof: Column) -> Column:
    """All siblings of a proof, from the leaf up to the root, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))
