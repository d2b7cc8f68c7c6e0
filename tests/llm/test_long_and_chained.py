"""Conversations and chains that are long: time and rounds must not grow with the square, or with the length."""

import random
import time

import pytest
from brute import near_components
from pyspark.sql import functions as F

from taxaspark.llm import chat, components, minhash_dedup

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def brute_chat(turns):
    """(formatted, loss spans) of turns in order; nothing in them needs an escape."""
    out, at, spans, role = [], 0, [], None

    def put(s):
        nonlocal at
        out.append(s)
        at += len(s)

    for r, t in turns:
        put(SEP if r == role else (END if role is not None else "") + START + r + "\n")
        if r == "assistant":
            spans.append((at + 1, len(t)))
        put(t)
        role = r
    put(END)
    return "".join(out), spans


@pytest.mark.parametrize("roles", [["user", "assistant"], ["assistant"], ["user", "user", "assistant", "assistant", "tool"]])
def test_chat_of_100_000_turns_in_linear_time(spark, roles):
    turns = [(roles[i % len(roles)], f"text {i} ü🙂" if i % 7 else "") for i in range(100_000)]
    rows = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    began = time.time()
    out = chat.format_chat(rows.repartition(8))
    got = out.select("messages", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"),
                     chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert time.time() - began < 60
    want, spans = brute_chat(turns)
    assert got["formatted"] == want
    assert [tuple(s) for s in got["loss_spans"]] == spans
    assert [tuple(t) for t in got["turns"]] == turns
    assert got["loss"] == "".join(t for r, t in turns if r == "assistant")
    assert [t for m in got["messages"] for t in m["texts"]] == [t for _, t in turns]
    assert all(a["role"] != b["role"] for a, b in zip(got["messages"], got["messages"][1:], strict=False))


def test_chat_of_a_very_long_text(spark):
    long = "x<|im_end|>\\ ü" * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "assistant", "y"), (2, 0, "assistant", None)]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"),
                                               chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", long), ("assistant", long), ("assistant", "y")]
    assert got[1]["loss"] == long + "y" and got[2]["loss"] == ""


def chain(n, order):
    ids = list(range(n))
    if order == "down":
        ids.reverse()
    if order == "shuffled":
        random.Random(1).shuffle(ids)
    if order == "zigzag":
        ids = [x for i in range(n // 2) for x in (i, n - 1 - i)]
    return list(zip(ids, ids[1:], strict=False))


@pytest.fixture
def tables(monkeypatch):
    """Names of the tables that the operators write."""
    names = []
    for module in (components, minhash_dedup):
        real = module.written
        monkeypatch.setattr(module, "written", lambda df, name, real=real: (names.append(name), real(df, name))[1])
    return names


@pytest.mark.parametrize("order", ["up", "down", "shuffled", "zigzag"])
def test_components_of_chains_in_few_rounds(spark, tables, order):
    edges = spark.createDataFrame(chain(2000, order), "u long, v long")
    got = components.components(edges, contract=False).collect()
    assert {(r["node"], r["component"]) for r in got} == {(i, 0) for i in range(2000)} and len(got) == 2000
    assert tables.count("edges") - 1 <= 16


def test_components_against_brute_force(spark, tables):
    rng = random.Random(5)
    pairs = [(rng.randrange(-50, 400), rng.randrange(-50, 400)) for _ in range(280)] + [(7, 7), (500, 501), (500, 501), (501, 500), (None, 3), (4, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in pairs:
        if u is not None and v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(5)
    for contract in (True, False):
        got = components.components(edges, contract=contract).collect()
        assert sorted((r["node"], r["component"]) for r in got) == sorted((x, root(x)) for x in parent)
    assert components.components(edges.limit(0)).collect() == []
    hub = spark.createDataFrame([(9999, i) for i in range(3000)] + [(9999, 20000)], "u long, v long")
    assert {(r["node"], r["component"]) for r in components.components(hub).collect()} == {(x, 0) for x in [*range(3000), 9999, 20000]}


def test_contraction_in_small_chunks(spark, monkeypatch):
    edges = spark.createDataFrame(chain(500, "shuffled"), "u long, v long").where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    monkeypatch.setattr(components, "CHUNK", 10)
    got = components.contracted(edges.repartition(3))
    assert {r["component"] for r in components.components(got).collect()} == {0}


def test_drifting_documents_are_joined_with_few_tables(spark, tables):
    """Versions of one page, each 80 % like the next: a chain of links."""
    step, size = 12, 110
    docs = {i: " ".join(f"w{j}" for j in range(i * step, i * step + size + 4)) for i in range(36)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(df, n=5).collect()}
    assert got == near_components(docs, 5, 80)
    assert len(set(got.values())) == 1
    assert len(tables) <= 19
