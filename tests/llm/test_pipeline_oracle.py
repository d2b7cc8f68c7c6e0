import duckdb
import pytest
from brute import contained, dedup_lines, near_components
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from taxaspark.llm import toxicity
from taxaspark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLE[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(r[cols.index(c)] for c in sorted(cols)) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=repr) == want


def test_all_queries_are_registered():
    names = queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.train(docs, toxicity.label_categories(labels), toxicity.CATEGORIES)
    toxic = {r["doc_id"] for r in toxicity.score(docs, chain).where("is_toxic").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in toxic}
    texts = {i: x[2] for i, x in dedup_lines(texts).items()}
    groups = near_components(texts, 5, 80)
    texts = {i: t for i, t in texts.items() if groups[i] == i}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    held = {d for d, _ in contained(texts, items)}
    texts = {i: t for i, t in texts.items() if i not in held}
    got = corpus_pipeline.run(spark, SF).collect()
    from tokenizers import Tokenizer

    from taxaspark.llm.queries import tokenizer_path
    t = Tokenizer.from_file(tokenizer_path())
    want = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in texts.items()}
    total, ends = {}, {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert total == want
    assert max(ends.values()) <= 2048


def test_stages_keep_columns_nulls_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, None, "en", "s", None), (-2, "", None, None, 0), (-2, "", None, None, 0)], docs.schema)
    every = docs.unionByName(odd).withColumn("key", F.lit("clash"))
    for own in (every, every.limit(0)):
        rows = own
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF)
            assert rows.columns == own.columns
        assert rows.count() == 0 if own is not every else {None, -1, -2} <= {r["doc_id"] for r in rows.collect()}
        corpus_pipeline.STAGES[-1][1](spark, rows, SF).count()
