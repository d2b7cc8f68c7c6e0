"""Secrets in texts, told apart by who owns them across the corpus.

Base kinds are patterns: ``assign`` (a keyword, a separator and a value),
``access`` (access key ids) and ``hex`` (long hexadecimal runs). They always stay.

The method adds spans of kind ``owned``: strings that look like a credential
(a known prefix, or long with high entropy and mixed characters) and that the
corpus shows to be someone's own. For that the hashes of all candidates are
aggregated over the corpus: in how many distinct repositories and by how many
distinct owners does each occur? A value that several owners have is a copied
example (documentation, a test vector), and so is one that a single owner has in
many repositories; one that one owner alone has, in few of them, looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import text_print, written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so shorter ones can be left out at once
#: a known prefix tells where a credential begins, so '=', a path or a sentence may surround it
PREFIXED = re.compile(r"(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                      r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)(?![A-Za-z0-9_-])")
#: without one, the whole run counts: no part of a path or of a dotted name, but a value after '=' or before a full stop
LONG = re.compile(r"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9_+/=-]|\.[A-Za-z0-9_+/-])")
#: no digit, no candidate: cheap to look for, and prose has few
DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) by start, then kind as listed. Code points, end exclusive."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda x: (x[0], x[2]))
    return [(s, e, KINDS[k], v) for s, e, k, v in found]


def entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def added_spans(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of further candidates, by start: none overlaps a base span or another."""
    if not DIGIT.search(text):
        return []
    taken = bytearray(len(text))  # a mark for each code point, so that texts of many spans take linear time
    for s, e, _, _ in base:
        taken[s:e] = b"\1" * (e - s)
    out = []
    for pattern in (PREFIXED, LONG):
        for m in pattern.finditer(text):
            (s, e), v = m.span(), m[0]
            mixed = any(c.isdigit() for c in v) and any(c.isalpha() for c in v)
            if mixed and entropy(v) >= 3.5 and not any(taken[s:e]):
                taken[s:e] = b"\1" * (e - s)
                out.append((s, e, v))
    return sorted(out)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("print", pa.binary())])


def candidates(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """``doc_id, fp, repository, owner, spans`` (kind, start, end, print of the value); kind ``owned``: still a candidate."""

    def row(text: str) -> list[dict]:
        base = base_spans(text)
        every = base + [(s, e, "owned", v) for s, e, v in added_spans(text, base)]
        return [{"kind": k, "start": s, "end": e, "print": hashlib.blake2b(v.encode(), digest_size=16).digest()} for s, e, k, v in every]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                some = batch.slice(a, 512)
                spans = pa.array([row(t or "") for t in some.column(4).to_pylist()], pa.list_(SPAN))
                yield pa.RecordBatch.from_arrays([*some.columns[:4], spans], ["doc_id", "fp", "repository", "owner", "spans"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_print(F.col("text")).alias("fp"),
                      repository.cast("string").alias("repository"), owner.cast("string").alias("owner"), "text")
    return own.mapInArrow(run, "doc_id bigint, fp bigint, repository string, owner string, "
                               "spans array<struct<kind:string,start:bigint,end:bigint,print:binary>>")


def scan(docs: DataFrame, repository: Column, owner: Column, max_owners: int = 1, max_repositories: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, fp, base, spans, n_owned, n_copied``.

    ``base`` is an array of (kind, start, end), in order of start and kind; ``spans`` too, with ``owners`` and
    ``repositories``: how many distinct ones the corpus has of the span's value. A candidate is ``owned`` if at most
    ``max_owners`` owners have its value, in at most ``max_repositories`` repositories (of all owners together); others are
    left out of ``spans``.
    n_owned, n_copied: of all spans, base included, how many have a value that is owner-specific (by both limits) or widely copied.
    Null or empty text: no spans. Null repository or owner: one unknown repository or owner.
    Repeated rows get equal results and count once. Null doc_id: an id like others.
    """
    found = written(candidates(docs, repository, owner), "secret-candidates")
    values = found.where(F.size("spans") > 0).select(
        "doc_id", "fp", F.coalesce("repository", F.lit("")).alias("repository"), F.coalesce("owner", F.lit("")).alias("owner"),
        F.explode("spans").alias("s")).select("doc_id", "fp", "repository", "owner", F.col("s.print").alias("print"))
    # distinct pairs first: a value that a third of all rows hold is as many rows as it has owners and repositories
    owners = values.select("print", "owner").distinct().groupBy("print").agg(F.count(F.lit(1)).alias("owners"))
    repositories = values.select("print", "repository").distinct().groupBy("print").agg(F.count(F.lit(1)).alias("repositories"))
    spread = written(owners.join(repositories, "print"), "secret-spread")
    judged = values.select("doc_id", "fp", "print").distinct().join(spread, "print")
    known = judged.groupBy(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).agg(
        F.map_from_entries(F.collect_list(F.struct("print", F.struct("owners", "repositories")))).alias("_spread"))
    joined = found.join(known, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")), "left")
    count = lambda s, of: F.element_at("_spread", s["print"])[of]
    mine = lambda s: F.coalesce((count(s, "owners") <= max_owners) & (count(s, "repositories") <= max_repositories), F.lit(False))
    order = {**{k: i for i, k in enumerate(KINDS)}, "owned": len(KINDS)}
    rank = lambda k: F.coalesce(*[F.when(k == name, i) for name, i in order.items()])
    place = lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
                               count(s, "owners").alias("owners"), count(s, "repositories").alias("repositories"))
    fields = lambda *names: lambda s: F.struct(*[s[x].alias(x) for x in names])
    plain = ("kind", "start", "end")
    every = F.filter("spans", lambda s: (s["kind"] != "owned") | mine(s))
    base = F.filter("spans", lambda s: s["kind"] != "owned")
    return joined.select(
        "doc_id", "fp", F.transform(base, fields(*plain)).alias("base"),
        F.transform(F.array_sort(F.transform(every, place)), fields(*plain, "owners", "repositories")).alias("spans"),
        F.size(F.filter("spans", mine)).cast("long").alias("n_owned"),
        F.size(F.filter("spans", lambda s: ~mine(s))).cast("long").alias("n_copied"))
