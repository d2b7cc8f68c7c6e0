"""URL rules in sorted digest arrays, memory-mapped and probed by binary search.

A digest array holds texts with a value each: 64-bit xxhash keys in sorted order,
then the ends of the texts and values, then these themselves. A Spark job
writes it to the shared folder as files of disjoint key ranges; rows with one
key never part. Tasks map the files, so only the pages that a probe touches are read, all
workers of a machine share them, and nothing of the rules goes through the driver but
a line for each file (name, first key). Where the shared folder is not a mounted path
(``hdfs://``, ``s3://``), a task reads the files that its probes fall in.

A key that is found is a candidate only: the stored text has to be equal.

Rules are two arrays: hosts (value: the lengths of their rules' paths), and
host and path (value: the verdict). A URL asks for its host and every
parent domain, and for the paths' beginnings of these lengths only under hosts that have
rules. Pages are not shuffled, and only host and path go to Python.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.session import ensure_checkpoint_dir

from .tables import shuffle_partitions

#: seed of Spark's own xxhash64, so that keys from Spark and from tasks agree
SEED = 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: Column) -> Column:
    """A-Z lower-cased."""
    return F.translate(text, UPPER, LOWER)


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return lower(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class DigestArray:
    """Files in order of their keys, and the first key of each."""

    files: list[str]
    first: np.ndarray
    bits: int


def key_of(text: Column, bits: int) -> Column:
    """The ``bits`` highest bits of the 64-bit xxhash, signed (all 64; fewer in tests, for collisions)."""
    return F.shiftright(F.xxhash64(text), 64 - bits) if bits < 64 else F.xxhash64(text)


def build(entries: DataFrame, name: str, bits: int = 64) -> DigestArray:
    """The digest array of ``entries`` (``text``, distinct and not null, and ``value``), in the shared folder.

    Files carry the number of the attempt that wrote them and count only if that attempt ends well,
    so retries and speculative tasks do no harm.
    """
    spark = entries.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        columns = [[x.encode() for x in table.column(c).to_pylist()] for c in (1, 2)]
        ends = [np.cumsum([len(x) for x in c], dtype="<i8") for c in columns]
        keys = table.column(0).to_numpy().astype("<i8")
        fs, at = filesystem(folder)
        fs.create_dir(at, recursive=True)
        file = f"part-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}.keys"
        with fs.open_output_stream(f"{at}/{file}") as out:
            for block in (np.array([len(keys)], "<i8").tobytes(), keys.tobytes(), *[e.tobytes() for e in ends], *[b"".join(c) for c in columns]):
                out.write(block)
        yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{file}"], "first": [int(keys[0])]})

    keyed = entries.select(key_of(F.col("text"), bits).alias("key"), F.col("text"), F.col("value").cast("string"))
    made = keyed.repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key", "text") \
        .mapInArrow(write, "file string, first bigint").collect()  # a line for each file
    made = sorted(made, key=lambda r: r["first"])
    return DigestArray([r["file"] for r in made], np.array([r["first"] for r in made], dtype=np.int64), bits)


class Shard:
    """One file, mapped where it lies on a mounted path."""

    def __init__(self, file: str) -> None:
        fs, path = filesystem(file)
        if isinstance(fs, pafs.LocalFileSystem):
            self.data = np.memmap(path, dtype=np.uint8, mode="r")
        else:
            with fs.open_input_file(path) as f:
                self.data = np.frombuffer(f.read(), dtype=np.uint8)
        n = int(self.data[:8].view("<i8")[0])
        self.keys, *self.ends = (self.data[8 + 8 * n * i : 8 + 8 * n * (i + 1)].view("<i8") for i in range(3))
        self.base = [8 + 24 * n, 8 + 24 * n + (int(self.ends[0][-1]) if n else 0)]

    def stored(self, which: int, i: int) -> bytes:
        ends = self.ends[which]
        return self.data[self.base[which] + (int(ends[i - 1]) if i else 0) : self.base[which] + int(ends[i])].tobytes()


class Probe:
    """Lookups in a digest array."""

    def __init__(self, array: DigestArray) -> None:
        self.array, self.shards = array, {}

    def find(self, texts: list[str]) -> dict[int, str]:
        """The values of the texts that are stored, by position."""
        found: dict[int, str] = {}
        if not texts or not self.array.files:
            return found
        raw = [t.encode() for t in texts]
        keys = np.array([xxhash.xxh64_intdigest(t, SEED) for t in raw], dtype=np.uint64).view(np.int64) >> (64 - self.array.bits)
        place = np.searchsorted(self.array.first, keys, "right") - 1
        for k in np.unique(place[place >= 0]).tolist():
            if k not in self.shards:
                self.shards[k] = Shard(self.array.files[k])
            shard, own = self.shards[k], np.flatnonzero(place == k)
            lo, hi = (np.searchsorted(shard.keys, keys[own], side) for side in ("left", "right"))
            for j in np.flatnonzero(lo < hi).tolist():
                i = int(own[j])
                for at in range(int(lo[j]), int(hi[j])):  # rows that share the key
                    if shard.stored(0, at) == raw[i]:
                        found[i] = shard.stored(1, at).decode()
                        break
        return found


def parents(host: str) -> list[str]:
    """The host itself and what follows each of its dots."""
    out = [host]
    while "." in host:
        host = host.split(".", 1)[1]
        out.append(host)
    return out


def rule_arrays(rules: DataFrame, bits: int = 64) -> tuple[DigestArray, DigestArray]:
    """The arrays of hosts and of rules. ``rules``: ``host, path, verdict``."""
    own = rules.where("host IS NOT NULL AND verdict IS NOT NULL") \
        .groupBy(lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path")).agg(F.max("verdict").alias("value"))
    hosts = own.groupBy(F.col("host").alias("text")).agg(F.array_join(F.sort_array(F.collect_set(F.char_length("path").cast("string"))), " ").alias("value"))
    return build(hosts, "hosts", bits), build(own.select(F.concat("host", F.lit("\0"), "path").alias("text"), "value"), "rules", bits)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", bits: int = 64) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict``.

    A rule fits its host and all subdomains if the URL's path starts with the rule's; of several the longest (host and
    path, in code points) wins, of equally long ones that with the longer host. Without one ``rule`` is null and the verdict ``default``.
    Rules: host in any case of A-Z; null path: empty; null host or verdict: no rule; of repeated rules the greatest
    verdict holds (``block`` before ``allow``). Host and path of a null URL, or one without ``://``, are empty. Columns of
    ``pages`` with the four names are replaced. Repeated rows are judged each; no pages: no rows; no rules: all ``default``.
    URLs of any length: a URL asks only for the path lengths that its domains' rules have.
    """
    hosts, paths = rule_arrays(rules, bits)

    def verdicts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        by_host, by_rule = Probe(hosts), Probe(paths)
        for host, path in batches:
            texts, owner = [], []  # parent domains of the batch's distinct hosts
            distinct = host.unique().tolist()
            for h in distinct:
                for p in parents(h):
                    texts.append(p)
                    owner.append(h)
            known: dict[str, list[tuple[str, list[int]]]] = {}
            for i, lengths in by_host.find(texts).items():
                known.setdefault(owner[i], []).append((texts[i], [int(n) for n in lengths.split(" ")]))
            asked, row = [], []
            for i, (h, p) in enumerate(zip(host, path, strict=True)):
                for name, lengths in known.get(h, ()):
                    for n in lengths:
                        if n <= len(p):
                            asked.append(f"{name}\0{p[:n]}")
                            row.append(i)
            best: dict[int, tuple[int, int, str, str]] = {}
            for i, verdict in by_rule.find(asked).items():
                name, start = asked[i].split("\0", 1)
                own = (len(name) + len(start), len(name), name + start, verdict)
                best[row[i]] = max(best.get(row[i], own), own)
            won = [best.get(i) for i in range(len(host))]
            yield pd.DataFrame({"rule": [w and w[2] for w in won], "verdict": [w[3] if w else default for w in won]})

    judged = F.pandas_udf(verdicts, "rule string, verdict string")
    link = F.col(url).cast("string")
    out = pages.withColumns({"_host": F.coalesce(host_of(link), F.lit("")), "_path": F.coalesce(path_of(link), F.lit(""))})
    out = out.withColumn("_won", judged("_host", "_path"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return out.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"), "_won.rule", "_won.verdict")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")
