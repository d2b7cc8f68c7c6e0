"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

1. toxicity: documents that the classifier chain rejects go.
2. line dedup: lines that three or more documents share stay only in the largest doc_id.
3. near-dedup: of each group of near-duplicates the smallest doc_id stays.
4. decontamination: documents that hold a benchmark item go.
5. packing: the documents as sequences of at most 2048 ids; a row is a piece with its ids and its place.

``n_chars`` follows the text where lines go. Nulls, empty texts, repeated rows and empty tables:
as the operators in ``taxaspark.llm`` say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.llm import decontamination, line_dedup, minhash_dedup, packing, toxicity
from taxaspark.llm.queries import tokenizer_path
from taxaspark.llm.tables import read, written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = toxicity.label_categories(read(spark, sf_dir, "labels"))
    chain = toxicity.train(docs, labels, toxicity.CATEGORIES)
    return toxicity.reject(docs, chain, "toxic")


def remove_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", remove_shared_lines),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("best-fit packing", pack),
]

#: a trained model and a tokenizer are no SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
