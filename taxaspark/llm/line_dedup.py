"""Removal of lines that many documents share, with Spark expressions only.

The keys of all lines become 128-bit hashes. Hashes are range-partitioned
with a salt of the document (a hot line spreads over many partitions) and
sorted by document (largest first) and position. One pass over each run marks
a document's first line of a hash; their number is the number of documents
and the first of a run is the largest doc_id. Runs of one hash are added up
over the salts, with partial aggregates. What goes back to the documents is
the compressed keep bitmap: the runs of kept line numbers. Texts are never
shuffled for the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import shuffle_partitions, text_print, written

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 64


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, fp, keep, n_dropped`` for every document that loses a line.

    ``keep`` is the run-length form of the document's bitmap: an array of
    (first line from 0, number of lines) of kept lines. Lines whose key has at least
    ``min_chars`` code points and occurs in at least ``min_docs`` documents are
    dropped, except in the largest doc_id that holds it (there all stay).
    """
    spark = docs.sparkSession
    lines = docs.select("doc_id", text_print(F.col("text")).alias("fp"),
                        F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("pos", "key"))
    # hashes and places only, written once: the range sampling, the runs and the join read them, not the texts
    keyed = written(lines.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "fp", "pos"),
        "line-hashes")
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    ranged = salted.repartitionByRange(shuffle_partitions(spark), "h1", "h2", "salt")
    run = Window.partitionBy("h1", "h2", "salt").orderBy(F.desc("doc_id"), "pos")
    # a new document begins where the one before, in the sorted run, is another
    first = ~F.lag(F.struct("doc_id")).over(run).eqNullSafe(F.struct("doc_id"))
    marked = ranged.select("h1", "h2", "doc_id", first.cast("long").alias("first"))
    # written, so that the join below reads plain shuffles, of which Spark can split a hot hash
    shared = written(marked.groupBy("h1", "h2").agg(F.sum("first").alias("n_docs"), F.max("doc_id").alias("keeper"))
                     .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"), "shared-lines")
    dropped = keyed.join(shared, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    per_doc = dropped.groupBy("doc_id", "fp").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    gone = F.col("gone")
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(F.lit(2147483647)))
    gaps = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("first"), (b - a - 1).alias("n")))
    return per_doc.select("doc_id", "fp", F.filter(gaps, lambda g: g["n"] > 0).alias("keep"),
                          F.size("gone").cast("long").alias("n_dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut to its kept lines, plus ``n_lines`` (before) and ``n_dropped``."""
    keys = bitmaps.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), F.col("keep").alias("_keep"),
                          F.col("n_dropped").alias("_dropped"))
    own = docs.withColumn("_print", text_print(F.col("text")))
    joined = own.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_print") == F.col("_fp")), "left")
    lines = split_lines(F.col("text"))
    kept = F.flatten(F.transform("_keep", lambda g: F.slice(lines, g["first"] + 1, g["n"])))
    text = F.when(F.col("_keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return joined.select(*[joined[c] for c in names], text.alias("text"),
                         F.size(lines).cast("long").alias("n_lines"),
                         F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Every document with its shared lines removed, ``n_lines`` and ``n_dropped`` added.

    Null or empty text: one empty line, which stays. Rows that repeat a doc_id
    are one document when documents are counted; rows with equal doc_id and
    text get the same result. Null doc_id: one document, smaller than all
    others. Other columns pass through, except for ``n_lines`` and
    ``n_dropped``, which are replaced. No rows: no rows.
    """
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
