import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from taxaspark.llm import alignment, merkle, queries, url_filter

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- Merkle manifest

def brute_levels(digests):
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute_proof(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 8 * 8: i // 8 * 8 + 8]
        out.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return out


def unchain(proof):
    out = []
    while proof:
        step, proof = proof
        out.append(step)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 72, 513, 4096])
def test_sweeps_against_levels(n):
    leaves = [H(str(i)) for i in range(n)]
    levels = brute_levels(leaves)
    assert merkle.sweep_up(leaves, merkle.height(n)) == levels
    got = dict(merkle.sweep_down(levels, (("above", ""), None)))
    assert sorted(got) == list(range(n))
    for i in {0, n // 2, n - 1}:
        assert unchain(got[i]) == [*brute_proof(levels, i), ("above", "")]


def brute_manifest(rows):
    """rows: (group, order, digest); list of (row, subroot, root, proof)."""
    key = lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])
    groups = {}
    for r in sorted(rows, key=key):
        groups.setdefault(r[0], []).append(r)
    trees = [brute_levels([r[2] for r in g]) for g in groups.values()]
    top = brute_levels([t[-1][0] for t in trees])
    return [(r, t[-1][0], top[-1][0], brute_proof(t, i) + brute_proof(top, j))
            for j, (g, t) in enumerate(zip(groups.values(), trees, strict=True)) for i, r in enumerate(g)]


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_against_brute_force(spark, levels):
    rng = random.Random(levels)
    sizes = {None: 9, "": 1, "en": 90, "fr": 8, "zz": 65, "\U0001F600": 2, "\uFFFD": 3} | {f"l{i}": 1 for i in range(6)}
    rows = [(g, rng.choice([None, *range(300)]), H(str(rng.random()))) for g, n in sizes.items() for _ in range(n)]
    rows += rows[:3]  # repeated rows are leaves of their own
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], "lang string, id bigint, leaf string, proof string, place int")
    got = merkle.manifest(df, "lang", ["id", "leaf"], "leaf", levels=levels)
    assert got.columns == ["lang", "id", "leaf", "place", "subroot", "root", "proof"]
    found = [((r["lang"], r["id"], r["leaf"]), r["subroot"], r["root"], [tuple(s) for s in r["proof"]]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_of_nothing_and_of_one_leaf(spark):
    df = spark.createDataFrame([("en", 1, H("x"))], "lang string, id bigint, leaf string")
    assert [tuple(r) for r in merkle.manifest(df, "lang", ["id", "leaf"], "leaf").collect()] == [("en", 1, H("x"), H("x"), H("x"), [])]
    assert merkle.manifest(df.limit(0), "lang", ["id", "leaf"], "leaf").collect() == []


def test_leaf_digest_and_query_on_odd_rows(spark, tmp_path):
    docs = [(i, ("Größe A " * (i % 5)) if i % 7 else None, "en" if i % 3 else None, "S", i) for i in range(40)]
    docs += [(40, "Z" * 3_000_000, "en", "S", 3_000_000), (None, "A", "en", None, None), (5, "other", "en", "S", 1), (5, "other", "en", "S", 1)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(f"{tmp_path}/documents.parquet")

    def leaf(d, text):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d[0], d[3], d[2], d[4], text)))

    want = []
    by_leaf = {}
    for d in docs:
        hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0
        by_leaf[leaf(d, d[1])] = leaf(d, d[1].translate(LOWER) if hit and d[1] is not None else d[1])
    for (_, i, digest), subroot, root, proof in brute_manifest([(d[2], d[0], leaf(d, d[1])) for d in docs]):
        now = by_leaf[digest]
        for before, after in proof:
            now = H(before + now + after)
        want.append((i, digest, subroot, root, H("".join(b + a for b, a in proof)), now, now == root))
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[6] for r in got} == {True, False}


# --- alignment

def brute_alignment(docs):
    a_path, b_path = queries.alignment_paths()
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    letters = {chr(x if x in plain else next(other)): x for x in range(256)}
    rows, count = [], Counter()
    for i, text in docs:
        ends, ids = [{}, {}], [[], []]
        if text:
            e = a.encode(" " + text, add_special_tokens=False)
            sides = [[(n, bytes(letters[c] for c in t)) for n, t in zip(e.ids, e.tokens, strict=True)],
                     [(n, bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode())
                      for n, p in ((n, b.id_to_piece(n)) for n in b.encode(text))]]
            if all(b"".join(x for _, x in s) == (" " + text).encode() for s in sides):
                for k, s in enumerate(sides):
                    at = 0
                    for n, x in s:
                        at += len(x)
                        ends[k][at] = n
                        ids[k].append((at, n))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        count.update(links)
        groups, left = [], [list(reversed(side)) for side in ids]
        for c in cuts:
            own = [[], []]
            for k in (0, 1):
                while left[k] and left[k][-1][0] <= c:
                    own[k].append(str(left[k].pop()[1]))
            groups.append("|".join(",".join(x) for x in own))
        rows.append((i, len(ids[0]), len(ids[1]), len(cuts), links, H(";".join(groups)) if groups else ""))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((i, na, nb, g, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), h)
                   for i, na, nb, g, links, h in rows), key=repr)


def test_alignment_against_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "Wörter", "tokenisation", "naïve", "日本語", "🙂🙂", "12345", "a\u2581b", "<|endoftext|>", "</s>", "<0x41>", "\n\n", "\t", "  ", "e\u0301", "\x00", "x" * 40]
    docs = [(i, " ".join(rng.choices(words[:7] + words[8:], k=rng.randrange(1, 40)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " "), (103, "\u2581"), (104, "a\u2581b c"), (105, "<|endoftext|>"), (106, "   x   "), (None, "the end"), docs[0], docs[0]]
    docs += [(107, "long words and 日本語 " * 20_000), (108, " " * 120_000 + "end")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, n_a string").repartition(3)
    chunks = alignment.align(df, *queries.alignment_paths(), chunk=200)
    got = alignment.with_counts(alignment.digested(chunks)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
    want = brute_alignment(docs)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert any(r[3] < min(r[1], r[2]) for r in want)  # groups of several tokens
    assert [r for r in want if r[0] == 104][0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_alignment_texts_and_nothing(spark):
    df = spark.createDataFrame([(1, "tokenisation of naïve words"), (2, None)], "doc_id bigint, text string")
    out = alignment.with_counts(alignment.align(df, *queries.alignment_paths())).orderBy("doc_id").collect()
    first = out[0]["groups"].split(";")
    assert len(first) == out[0]["n_groups"] and all(g.count("|") == 1 for g in first) and out[1]["groups"] == ""
    assert alignment.with_counts(alignment.align(df.limit(0), *queries.alignment_paths())).collect() == []
    assert [r["n_links"] for r in alignment.with_counts(alignment.align(df.where("doc_id = 2"), *queries.alignment_paths())).collect()] == [0]


def test_coalesce_and_overlaps_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(50):
        total = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, total + 1, size=rng.integers(0, 30)), total)) for _ in range(2)]
        starts = [np.concatenate([[0], e[:-1]]) for e in ends]
        ga, gb = alignment.coalesce(starts[0], ends[0], starts[1], ends[1])
        cuts = np.intersect1d(*ends)
        assert ga.tolist() == np.searchsorted(cuts, ends[0]).tolist() and gb.tolist() == np.searchsorted(cuts, ends[1]).tolist()
        a, b = alignment.overlaps(starts[0], ends[0], starts[1], ends[1])
        want = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and len(a) == len(want)
        assert (ga[a] == gb[b]).all()


# --- URL rules

def brute_judge(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].translate(LOWER), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h.translate(LOWER)) + len(p or ""), len(h), v, h.translate(LOWER) + (p or "")) for v, h, p in rules if h is not None and v is not None
            and (host == h.translate(LOWER) or host.endswith("." + h.translate(LOWER))) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = ["http://a.net/", "https://net/x", "http://xnet/", "http://a.example.net/en/1?x=/de/", "http://EXAMPLE.net/en/", "http://example.net/en", "http://b.example.com/de/#a",
        "ftp://example.com/fr/", "http://x.org/fr/a.html", "http://org", "http://org?/fr/", "no scheme", "", None, "://", "http://", "http:///fr/", "http://.net/", "http://a..net/x",
        "http://a.net:80/", "http://u@net/", "x://y://net/", "http://a.net#/", "http://ünï.example.com/de/ß", "http://a\nb.net/c\nd?", "http://" + "sub." * 300 + "org/fr/" + "x" * 100_000]
RULES = [*queries.URL_RULES, ("block", "Example.NET", "/en/secret"), ("allow", "org", "/fr/"), ("block", "org", "/fr/"), ("block", "b.example.com", None),
         ("allow", None, "/"), (None, "net", "/x"), ("block", "ünï.example.com", "/de/ß"), ("allow", "", "/fr/")]


@pytest.mark.parametrize("bits", [64, 2])
def test_judge_against_brute_force(spark, bits):
    rng = random.Random(bits)
    made = [f"http://{rng.choice(['a.', 'www.', ''])}{rng.choice(['net', 'org', 'example.net', 'b.example.com', 'com'])}/{rng.choice(['en', 'de', 'fr'])}{rng.choice(['', '/', '/secret'])}"
            for _ in range(100)]
    urls = URLS + made + made[:5]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string, verdict string")
    for rules in (RULES, queries.URL_RULES):
        got = url_filter.judge(df, url_filter.rule_table(spark, rules), bits=bits).orderBy("page_id").collect()
        assert got[0].asDict().keys() == {"page_id", "url", "host", "path", "rule", "verdict"}
        assert [tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in got] == [brute_judge(u, rules) for u in urls]
    assert {r["verdict"] for r in got} == {"allow", "block"}


def test_judge_many_rules_no_rules_no_pages(spark):
    rules = [("block" if i % 2 else "allow", f"h{i % 700}.example", f"/p{i % 13}/" if i % 5 else "") for i in range(3000)]
    urls = [f"http://www.h{i % 900}.example/p{i % 17}/x" for i in range(2000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_filter.judge(df, url_filter.rule_table(spark, rules)).orderBy("page_id").collect()
    by_host = {}
    for r in rules:
        by_host.setdefault(r[1], []).append(r)
    assert [(r["rule"], r["verdict"]) for r in got] == [brute_judge(u, by_host.get(u.split("/")[2][4:], []))[2:] for u in urls]
    none = url_filter.rule_table(spark, rules).limit(0)
    assert {(r["rule"], r["verdict"]) for r in url_filter.judge(df, none, default="block").collect()} == {(None, "block")}
    assert url_filter.judge(df.limit(0), url_filter.rule_table(spark, rules)).collect() == []


def test_keys_agree_and_equal_keys_are_told_apart(spark):
    texts = ["", "net", "example.net\0/en/", "ß🙂" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["k"] for r in df.select("text", F.xxhash64("text").alias("k")).collect()}
    assert got == {t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), url_filter.SEED)).view(np.int64)) for t in texts}
    array = url_filter.build(df.withColumn("value", F.length("text")), "probe", bits=1)
    found = url_filter.Probe(array).find([*texts, "absent", "nets", "e"])
    assert {i: int(v) for i, v in found.items()} == {i: len(t) for i, t in enumerate(texts)}
