"""Benchmark items inside documents: size-partitioned containment search by item signatures, with Spark expressions only.

A short item inside a long document has a tiny Jaccard similarity, so MinHash signatures of
whole documents cannot find it (the README has figures). The search is on containment instead: an item is
represented by some of its shingle hashes, and a document is a
candidate if it holds one of them. Items are partitioned by size: an item with
q shingles gives floor(q * (100 - percent) / 100) + 1 hashes, one more than
a document may lack, so a document that contains ``percent`` % of an item holds
at least one of them, whichever they are: nothing is lost (of items of n words or more; for shorter
ones see ``contained_items``). They are those that the fewest items share, so that a shared template
does not make every document that holds it a candidate for every item. A document
too small to hold ``percent`` % of an item is no candidate for it.
Candidates are verified by the exact containment of the item's whole set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .line_dedup import ascii_lower
from .tables import text_print, written


def word_list(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; null: none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def hashed(df: DataFrame, n: int, *keep: Column) -> DataFrame:
    """``keep``, ``long`` (n words at least) and ``shingles`` of ``text``.

    Shingles are 64-bit hashes of n words each, as they stand (with repeats); with fewer words, one for the whole
    sequence; without words, none. Words and their hashes are columns of their own, so that each is made once.
    """
    words = df.select(*keep, word_list(F.col("text")).alias("_words"))
    names = [c for c in words.columns if c != "_words"]
    few = F.array(F.xxhash64(F.lit("few"), F.array_join("_words", " ")))
    size = F.size("_h")
    coded = words.select(*names, F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
                         F.when((F.size("_words") < n) & (F.size("_words") > 0), few).alias("_few"))
    whole = F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.xxhash64(*[F.element_at("_h", i + k) for k in range(n)]))
    none = F.array().cast("array<bigint>")
    return coded.select(*names, (size >= n).alias("long"), F.when(size >= n, whole).otherwise(F.coalesce("_few", none)).alias("shingles"))


def item_sets(items: DataFrame, n: int, percent: int) -> DataFrame:
    """``item_id, n_same, long, set, q, k``: one row for each distinct set of item shingles, under its smallest item_id."""
    sets = hashed(items.select("item_id", "text"), n, F.col("item_id")) \
        .select("item_id", "long", F.array_sort(F.array_distinct("shingles")).alias("set")).where(F.size("set") > 0)
    same = sets.groupBy("set", "long").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_same"))
    q = F.size("set")
    return same.select("item_id", "n_same", "long", "set", q.alias("q"),
                       (F.floor(q * (100 - percent) / 100) + 1).cast("int").alias("k"))


def signatures(sets: DataFrame) -> DataFrame:
    """``item_id, set_print, q, k, h``: the ``k`` shingles of each item that the fewest items share (ties: smallest hash).

    Any ``k`` shingles keep the guarantee; these keep shingles of a template that many items share out of the lookup,
    wherever an item has enough others.
    """
    each = sets.select("item_id", F.xxhash64("set").alias("set_print"), "q", "k", F.explode("set").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("n_items"))
    chosen = each.join(shared, "h").groupBy("item_id", "set_print", "q", "k").agg(F.sort_array(F.collect_list(F.struct("n_items", "h"))).alias("of"))
    return chosen.select("item_id", "set_print", "q", "k", F.explode(F.slice("of", F.lit(1), F.col("k"))).alias("s")) \
        .select("item_id", "set_print", "q", "k", "s.h")


def probes(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, fp, n, h``: the shingles of each document, to look up (h null for a document without any).

    Outer, as a plain explode lets the optimiser push a test of the array's size below the projections that make it.
    """
    found = hashed(docs, n, F.col("doc_id"), text_print(F.col("text")).alias("fp"))
    return found.select("doc_id", "fp", F.size("shingles").alias("n"), F.explode_outer("shingles").alias("h"))


def candidate_pairs(docs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, fp, item_id, set_print``: documents that hold a signature hash of an item and are large enough for it."""
    chosen = written(signatures(sets), "item-signatures")
    return probes(docs, n).join(chosen, "h").where(F.col("n") * 100 >= F.col("q") * percent) \
        .select("doc_id", "fp", "item_id", "set_print").distinct()


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row for each document and item set it holds: ``doc_id, fp, item_id, n_same, n_item, n_shared``.

    ``docs``: doc_id, text; ``items``: item_id, text. An item is held if
    100 * n_shared >= percent * n_item, over distinct ``n``-word shingles. An item
    of fewer words is held only by documents that consist of the same words.
    Items without words (null, empty) are held by none. Items with one set are
    one class: its smallest item_id stands for ``n_same`` of them. Null ids
    are ids like others. Repeated documents (equal doc_id and text) give one row. Texts of any length are searched whole;
    the tests go up to 1,200,000 words.
    """
    sets = written(item_sets(items, n, percent), "item-sets")
    fp = text_print(F.col("text")).alias("fp")
    listed = candidate_pairs(docs, sets, n, percent).withColumnRenamed("item_id", "_item").join(
        sets, F.col("_item").eqNullSafe(F.col("item_id")) & (F.col("set_print") == F.xxhash64("set")))
    by_doc = listed.groupBy(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).agg(
        F.collect_list(F.struct("item_id", "n_same", "set")).alias("_items"))
    own = docs.select("doc_id", "text", fp)
    found = own.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")))
    checked = hashed(found, n, F.col("doc_id"), F.col("fp"), F.col("_items")).select(
        "doc_id", "fp", "_items", F.array_distinct("shingles").alias("_set"))
    verified = checked.select("doc_id", "fp", F.explode(F.transform("_items", lambda i: F.struct(
        i["item_id"].alias("item_id"), i["n_same"].alias("n_same"), F.size(i["set"]).cast("long").alias("n_item"),
        F.size(F.array_intersect(i["set"], F.col("_set"))).cast("long").alias("n_shared")))).alias("i"))
    return verified.select("doc_id", "fp", "i.*").where(F.col("n_shared") * 100 >= F.col("n_item") * percent).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, without the documents that hold an item (see ``contained_items``)."""
    held = contained_items(docs, items, n, percent).select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).distinct()
    own = docs.withColumn("_print", text_print(F.col("text")))
    left = own.join(held, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_print") == F.col("_fp")), "left_anti")
    return left.select(*docs.columns)
