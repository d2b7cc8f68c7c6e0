import random

import numpy as np
import pyarrow as pa
from brute import contained, near_components, remove_repeats, shingles, words
from pyspark.sql import functions as F

from taxaspark.llm import components, decontamination, minhash_dedup, substring_dedup
from taxaspark.llm.words import Hasher, text_chunks

SCHEMA = "doc_id bigint, text string, node string, family string, fp string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def near_texts(seed, groups=8, vocabulary=400):
    """Originals, and copies with a few words changed, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    out = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.randrange(1, 12)):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own) if rng.random() < .5 else "  ".join(own).upper() + "\n")
    return out + [None, "", " \n\t", "one", "ONE", "one two", "x" * 50000]


def check_near(spark, rows, n):
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(frame(spark, rows), n=n).collect()}
    want = near_components(dict(rows), n, 80)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["kept"] for i, r in got.items()} == {i: i == c for i, c in want.items()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(shingles(t, n)) for i, t in rows}


def test_near_dedup_against_brute_force(spark):
    texts = near_texts(1)
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    check_near(spark, list(zip(ids, texts, strict=True)), 4)


def test_near_dedup_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "SMALL_BLOCK", 4)
    monkeypatch.setattr(minhash_dedup, "BUCKET_BLOCK", 3)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(60):  # one family, whose members are similar to some others only
        own = list(base)
        for _ in range(rng.randrange(0, 6)):
            own[rng.randrange(100)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(own))
    check_near(spark, list(enumerate(texts)), 5)


def test_near_dedup_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (3, text), (None, text), (7, None), (7, "other words are here now")]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (7, 7, True), (7, 7, True)], key=repr)
    left = minhash_dedup.drop_near_duplicates(frame(spark, rows))
    assert left.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert sorted((repr(r["doc_id"]) for r in left.collect())) == ["3", "7", "7", "None"]
    assert minhash_dedup.near_duplicates(frame(spark, [])).collect() == []


def test_estimate_is_corrected_for_chance():
    assert minhash_dedup.least_equal(0.8, 2, 1000, 0) == 850
    a = np.array([[0, 5]], dtype=np.uint64)
    assert minhash_dedup.equal_values(a, np.array([[0, 4]], dtype=np.uint64), 2, 64)[0] == 63


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_words_are_split_as_stated():
    texts = ["a b", "", None, "\x0b\x0c \x1c x\x85y é\xa0z", " lead", "trail ", "a" * 3_000_000 + " b"]
    hasher, seen = Hasher(False), {}
    for a, b, data, offsets in text_chunks(pa.array(texts)):
        _, _, h, first = hasher.words(data, offsets)
        for i in range(b - a):
            own = words(texts[a + i])
            assert first[i + 1] - first[i] == len(own)
            for w, x in zip(own, h[first[i]:first[i + 1]].tolist(), strict=True):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def repeat_texts(seed):
    rng = random.Random(seed)
    passages = [[f"p{k}_{i}" for i in range(rng.randrange(15, 60))] for k in range(6)]
    out = []
    for _ in range(40):
        own = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p) + 1)))
            own += p[a:b] if rng.random() < .5 else p
            own += [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(0, 12))]
        out.append(rng.choice([" ", "\n", " \t"]).join(own))
    return out + ["a " * 100, "b " * 20, "a b " * 30, None, "", "x", "Same " * 19, "same " * 19]


def test_substring_dedup_against_brute_force(spark):
    for seed, window in ((1, 20), (2, 35), (3, 17)):
        texts = repeat_texts(seed)
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in
               substring_dedup.remove_repeats(frame(spark, list(enumerate(texts))).repartition(3), window).collect()}
        assert got == dict(enumerate(remove_repeats(texts, window)))


def test_substring_dedup_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = substring_dedup.remove_repeats(frame(spark, [(1, text), (1, text), (None, "own words " + text)])).collect()
    assert sorted((repr(r["doc_id"]), r["n_removed"], r["text"]) for r in got) == [("1", 40, ""), ("1", 40, ""), ("None", 40, "own words")]
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []


def item_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "item_id bigint, text string, doc_id string")


def test_containment_against_brute_force(spark):
    rng = random.Random(4)
    items = {i: " ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 30, 60]))) for i in range(25)}
    items |= {100: items[7], 101: None, 102: "", 103: "  "}
    docs = {}
    for d in range(40):
        own = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 400))]
        for _ in range(rng.randrange(3)):
            w = words(items[rng.randrange(25)])
            cut = w[: max(1, int(len(w) * rng.choice([.5, .8, .9, 1])))]
            at = rng.randrange(len(own) + 1)
            own[at:at] = [x.upper() for x in cut]
        docs[d] = " ".join(own) if own else None
    docs |= {50 + i: items[i] for i in range(25)}
    found = decontamination.contained_items(frame(spark, list(docs.items())), item_frame(spark, list(items.items()))).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_shared"] for r in found} == contained(docs, items)
    assert len(found) == len(contained(docs, items))


def test_a_template_that_all_items_share_makes_no_candidates(spark):
    """2,000 items on one template, 2,000 documents that hold it, 100 of which hold an item."""
    own = lambda i, n, w: " ".join(f"{w}{i}x{k}" for k in range(n))
    template = own(0, 20, "t")
    items = {i: f"{template} {own(i, 15, 'i')}" for i in range(2000)}
    docs = {d: f"{own(d, 30, 'd')} {items[d] if d < 100 else template} {own(d, 9, 'e')}" for d in range(2000)}
    d, b = frame(spark, list(docs.items())), item_frame(spark, list(items.items()))
    pairs = decontamination.candidate_pairs(d, decontamination.item_sets(b, 5, 80), 5, 80)
    assert 100 <= pairs.count() < 1000
    found = decontamination.contained_items(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(100)}


def test_items_of_one_id_and_items_of_nothing_but_a_template(spark):
    template = " ".join(f"t{k}" for k in range(12))
    items = [(1, template), (1, template + " a b"), (2, template + " c"), (None, "n1 n2 n3 n4 n5 n6"), (3, template)]
    docs = [(10, "x " + template + " a b y"), (11, template), (None, "z n1 n2 n3 n4 n5 n6"), (12, "t0 t1 t2 t3")]
    found = decontamination.contained_items(frame(spark, docs), item_frame(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"], r["n_item"]) for r in found}
    assert got == {(d, i, n) for d in (10, 11) for i, n in ((1, 8), (1, 10), (2, 9))} | {(None, None, 2)}
    assert {r["n_same"] for r in found if r["n_item"] == 8} == {2}


def test_containment_in_a_very_long_document(spark):
    item = " ".join(f"i{k}" for k in range(30))
    long = "word other third " * 200_000
    docs = [(1, long + item + " " + long), (2, long)]
    found = decontamination.contained_items(frame(spark, docs), item_frame(spark, [(7, item)])).collect()
    assert [(r["doc_id"], r["item_id"], r["n_shared"]) for r in found] == [(1, 7, 26)]


def test_items_of_fewer_words_are_found_only_as_whole_documents(spark):
    """The rule of the query's SQL, and the exception that the README names."""
    items = {n: " ".join(f"i{n}w{k}" for k in range(n)) for n in (1, 2, 3, 4, 5)}
    docs = {n: t.upper() for n, t in items.items()} | {10 + n: f"before {t} after these words" for n, t in items.items()}
    found = decontamination.contained_items(frame(spark, list(docs.items())), item_frame(spark, list(items.items()))).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(n, n) for n in items} | {(15, 5)} == set(contained(docs, items))


def test_decontaminate_edge_cases(spark):
    item = "one two three four five six seven"
    rows = [(1, "start " + item + " end"), (1, "start " + item + " end"), (None, item), (2, None), (3, ""), (4, "clean words only here today")]
    left = decontamination.decontaminate(frame(spark, rows), item_frame(spark, [(1, item), (2, item), (None, None)]))
    assert sorted(repr(r["doc_id"]) for r in left.collect()) == ["2", "3", "4"]
    assert decontamination.decontaminate(frame(spark, rows), item_frame(spark, [])).count() == 6
    assert decontamination.decontaminate(frame(spark, []), item_frame(spark, [(1, item)])).collect() == []
