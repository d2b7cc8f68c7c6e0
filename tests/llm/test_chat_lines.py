import random

import pytest
from brute import dedup_lines as brute_lines
from pyspark.sql import functions as F

from taxaspark.llm import chat, line_dedup

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string"


def formatted(spark, rows):
    out = chat.format_chat(spark.createDataFrame([(*r, "clash") for r in rows], TURNS))
    back = out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.size("messages").alias("n"))
    return {r["conv_id"]: r for r in back.collect()}


def test_chat_round_trip_with_control_strings(spark):
    odd = ["<|im_end|>\n", "<|im_sep|>", "<\\|a", "<\\\\|im_end|>", "<", "|im_end|>", "", None, "a\nb", "<|nl|>", "\\", "é<|", "<<|x"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(odd)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(odd)]
    rows += [(3, 0, "we<|ird\nrole", "x"), (3, 1, None, "y"), (None, 5, "user", "z"), (4, None, "user", "first"), (4, 0, "assistant", "second")]
    got = formatted(spark, rows)
    for conv in (1, 2):
        own = [(r[2], r[3] or "") for r in rows if r[0] == conv]
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == own
        assert got[conv]["loss"] == "".join(t for r, t in own if r == "assistant")
    assert got[2]["n"] == 1  # one message: adjacent turns of one role are merged
    assert [(t["role"], t["text"]) for t in got[3]["turns"]] == [("we<|ird\nrole", "x"), ("", "y")]
    assert [t["text"] for t in got[4]["turns"]] == ["first", "second"]
    assert got[None]["turns"][0]["text"] == "z"


def test_chat_ties_repeats_and_empty(spark):
    got = formatted(spark, [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c"), (1, 0, "user", "a")])
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("assistant", "c"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert formatted(spark, []) == {}


def test_chat_merges_long_conversations(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", str(i)) for i in range(300)]
    got = formatted(spark, rows)[1]
    assert [t["text"] for t in got["turns"]] == [str(i) for i in range(300)]
    assert got["n"] == 200


DOCS = "doc_id bigint, text string, n_lines string, key string"


def lines_of(spark, rows):
    return line_dedup.dedup_lines(spark.createDataFrame([(*r, "clash", "k") for r in rows], DOCS))


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    pool = [f"a line that many documents share {i}" for i in range(6)] + ["SHORT", "", "  padded line number of twenty+  ",
                                                                       "\x0bÄ LINE WITH Ümlauts of some length\x0c", "x" * 20, "x" * 19]
    rows = []
    for i in range(40):
        own = [rng.choice(pool).upper() if rng.random() < .2 else rng.choice(pool) for _ in range(rng.randrange(8))]
        rows.append((i, rng.choice([None, "", "\n", "\n\n"]) if rng.random() < .1 else "\n".join(own)))
    rows.append((99, "\n".join(["the hot line of a very long document"] * 5000 + pool)))
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in lines_of(spark, rows).collect()}
    assert got == brute_lines(dict(rows))


def test_lines_repeated_rows_null_ids_and_clashing_columns(spark):
    line = "this line is long enough to count"
    out = lines_of(spark, [(1, line), (1, line), (2, line), (None, line), (3, line + "\nown"), (3, "another text")])
    assert out.columns == ["doc_id", "key", "text", "n_lines", "n_dropped"]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert got == sorted([(1, ""), (1, ""), (2, ""), (None, ""), (3, line + "\nown"), (3, "another text")], key=repr)
    assert lines_of(spark, []).collect() == []


@pytest.mark.parametrize("docs,dropped", [(2, 0), (3, 2)])
def test_lines_need_three_documents(spark, docs, dropped):
    out = lines_of(spark, [(i, "exactly the same line everywhere") for i in range(docs)]).collect()
    assert sum(r["n_dropped"] for r in out) == dropped
