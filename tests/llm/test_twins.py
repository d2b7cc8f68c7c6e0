"""Plain Python twins of the operators that SQL cannot express: features and scoring of the fitted models, and the corpus counts of secrets."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaspark.llm import language_id, secrets, toxicity
from taxaspark.llm.words import Hasher, mix, randoms

MASK = 2**64 - 1
WORDS = ["nice", "awful", "bloody", "Thing", "größe", "straße", "x", "weather", "terrible-looking", "a1b2", "ÉTÉ", "naïve", "日本語", "ok.", "(well)"]
ODD = [None, "", " ", "\n\n", "...", "a", "É", "日本 語", "\x00", "x" * 5000, "word " * 40_000, "1234 5678"]


def texts(n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 60))) for _ in range(n)] + ODD


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def bucket_of(hasher, text):
    """Bucket of a run of bytes, from a document that holds nothing else."""
    data = np.frombuffer(text, dtype=np.uint8)
    return int(hasher.spans(data, np.array([0]), np.array([len(data)]))[0])


def toxic_twin(chain, text):
    hasher, held = Hasher(True), set()
    raw = (text or "").encode()
    words = [w for w in re.split(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", raw) if w]
    for w in words:
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        held.add(bucket_of(hasher, w) & (toxicity.BUCKETS - 1))
        for n in toxicity.BEGINNINGS:
            if len(w) > n:
                held.add((bucket_of(hasher, w[:n]) * (2 * n + 1) & MASK) & (toxicity.BUCKETS - 1))
    value, found = max(1, len(words) / 300) ** -0.25, []
    for m in chain.models:
        weights = dict(zip(m.buckets.tolist(), m.weights.tolist(), strict=True))
        s = sum(weights.get(b, 0.0) for b in held) * value + m.bias
        for c, p in zip(m.chained.tolist(), found, strict=True):
            p = min(max(p, 1e-4), 1 - 1e-4)
            s += c * math.log(p / (1 - p))
        found.append(1 / (1 + math.exp(-min(max(s, -35), 35))))
    return found, [p >= m.threshold for p, m in zip(found, chain.models, strict=True)]


def test_toxicity_scores_against_a_plain_twin(spark):
    every = texts(120, 1)
    rows = [(i, t, "clash") for i, t in enumerate(every)] + [(3, every[3], "clash"), (None, "awful thing", "clash")]
    docs = frame(spark, rows, "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([(i, int("awful" in (t or "")), int("bloody" in (t or "") and i % 9 > 0)) for i, t in enumerate(every)], "doc_id long, a int, b int")
    chain = toxicity.train(docs, labels, ["a", "b"])
    assert sum(len(m.buckets) for m in chain.models) > 0
    got = toxicity.score(docs, chain).collect()
    want = sorted((repr(i), *toxic_twin(chain, t)) for i, t, _ in rows)
    assert len(got) == len(want)
    for r, (i, p, yes) in zip(sorted(got, key=lambda r: (repr(r["doc_id"]), r["p_a"], r["p_b"])), want, strict=True):
        assert repr(r["doc_id"]) == i
        assert [r["p_a"], r["p_b"]] == pytest.approx(p, abs=1e-9)
        assert [r["is_a"], r["is_b"]] == yes or any(abs(x - m.threshold) < 1e-9 for x, m in zip(p, chain.models, strict=True))


def language_twin(model, text):
    letters = text is not None and any(c.isalpha() for c in text)
    if not letters or not model.languages:
        return "und", 0.0
    points = []
    for c in map(ord, text):
        if 65 <= c <= 90 or 0xC0 <= c <= 0xDE and c != 0xD7 or 0x391 <= c <= 0x3A9 or 0x410 <= c <= 0x42F:
            c += 32
        points.append(c if 97 <= c <= 122 or c >= 0xAA else 0)
    factors = [int(x) | 1 for x in randoms(max(language_id.ORDERS), 31)]
    total, n = np.zeros(len(model.languages)), 0
    for k in language_id.ORDERS:
        for i in range(len(points) - k + 1):
            gram = points[i:i + k]
            if not any(gram) or k == 3 and not gram[1]:
                continue
            h = k
            for p, f in zip(gram, factors, strict=False):
                h = (h + p * f) & MASK
            total += model.weights.astype(np.float32).astype(float)[int(mix(np.array([h], dtype=np.uint64))[0]) >> (64 - language_id.BITS)]
            n += 1
    s = (total / max(n, 1) + model.bias) / model.temperature
    p = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    return model.languages[int(p.argmax())], float(p.max())


def test_language_scores_against_a_plain_twin(spark):
    rng = random.Random(2)
    speech = {"aa": "the weather is nice and the street was long".split(), "bb": "die straße größer wäre schöne häuser".split(), "cc": "été naïve garçon où château".split()}
    rows = []
    for i in range(150):
        lang = rng.choice(list(speech))
        rows.append((i, " ".join(rng.choice(speech[lang]).upper() if rng.random() < .2 else rng.choice(speech[lang]) for _ in range(rng.randrange(3, 40))), lang, "clash", 1))
    rows += [(500 + i, t if t is None or len(t) < 10_000 else t[:6000], None, "clash", 1) for i, t in enumerate(ODD)] + [rows[0], (None, rows[1][1], "aa", "clash", 1)]
    docs = frame(spark, rows, "doc_id long, text string, lang string, lang_pred string, score int")
    model = language_id.train(docs, learnable=F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False)))
    got = sorted(((repr(r["doc_id"]), r["lang_pred"], r["score"]) for r in language_id.predict(docs, model).collect()), key=repr)
    want = sorted(((repr(i), *language_twin(model, t)) for i, t, *_ in rows), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-4)
    assert got.count(got[0]) >= 1 and {"und"} < {g[1] for g in got}


def test_language_learns_only_from_rows_with_a_language(spark):
    rows = [(i, "the weather is nice", "aa") for i in range(0, 30, 3)] + [(i, "die schöne straße", "bb") for i in range(30, 60, 3)]
    plain = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    more = spark.createDataFrame(rows + [(1000 + i, f"zzz qqq {i}", None) for i in range(200)], "doc_id long, text string, lang string")
    again = language_id.train(more, F.lit(True))
    assert np.array_equal(plain.weights, again.weights) and plain.temperature == again.temperature


def test_language_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(0, "the weather is nice", "aa"), (3, "die schöne straße", "bb"), (4, "die schöne straße " * 120_000, None)], "doc_id long, text string, lang string")
    model = language_id.train(docs, F.lit(True))
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}[4] in ("aa", "bb")


def secret_twin(rows, max_owners, max_repositories):
    """(doc_id, repository, owner, text) rows -> for each (kind, start, end) of its owned and base spans with the counts."""
    def spans(text):
        base = secrets.base_spans(text)
        taken, out = [(s, e) for s, e, _, _ in base], []
        for pattern in (secrets.PREFIXED, secrets.LONG):
            for m in re.finditer(pattern.pattern, text):
                v, n = m[0], Counter(m[0])
                bits = -sum(c / len(v) * math.log2(c / len(v)) for c in n.values())
                if any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and bits >= 3.5 and all(e <= m.start() or s >= m.end() for s, e in taken):
                    taken.append(m.span())
                    out.append((*m.span(), "owned", v))
        return base + out

    owners, repositories = {}, {}
    for _, r, o, t in rows:
        for *_, v in spans(t or ""):
            owners.setdefault(v, set()).add(o or "")
            repositories.setdefault(v, set()).add(r or "")
    out = []
    rank = {k: i for i, k in enumerate((*secrets.KINDS, "owned"))}
    for i, _, _, t in rows:
        found, mine = [], 0
        every = spans(t or "")
        for s, e, k, v in every:
            own = len(owners[v]) <= max_owners and len(repositories[v]) <= max_repositories
            mine += own
            if k != "owned" or own:
                found.append((s, rank[k], e, k, len(owners[v]), len(repositories[v])))
        out.append((i, [(k, s, e, a, b) for s, _, e, k, a, b in sorted(found)], mine, len(every) - mine))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [(1, 3), (2, 5)])
def test_secret_spans_owners_and_repositories_against_a_twin(spark, limits):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda n: "".join(rng.choice(letters) for _ in range(n))
    pool = [f"ghp_{key(24)}", f"sk-{key(30)}", f"xoxb-{key(12)}", f"eyJ{key(10)}.{key(12)}.{key(9)}", key(40), key(26) + "==", "a" * 40, f"AKIA{key(16).upper()}",
            "0123456789abcdef" * 2, "docs/path/" + key(30), key(24) + ".example", f"token={key(12)}", f'password: "{key(8)}"']
    rows = []
    for i in range(120):
        own = [rng.choice(pool) if rng.random() < .7 else key(rng.randrange(20, 45)) for _ in range(rng.randrange(4))]
        text = "".join(rng.choice([" see {} now", "KEY={}", "\n{}\n", "it was {}.", "({})", "ü🙂{}"]).format(x) for x in own)
        rows.append((i % 110 if i else None, rng.choice([None, *(f"r{j}" for j in range(12))]), rng.choice([None, "o1", "o1", "o1", "o2", "o3"]), rng.choice([text, text, None, ""]) if i % 10 == 0 else text))
    rows.append((999, "r1", "o1", ("words and " + pool[0] + " ") * 1500))
    df = frame(spark, rows, "doc_id long, repository string, owner string, text string")
    got = secrets.scan(df, F.col("repository"), F.col("owner"), *limits).collect()
    found = sorted(((r["doc_id"], [tuple(s) for s in r["spans"]], r["n_owned"], r["n_copied"]) for r in got), key=repr)
    # rows of one doc_id and text are one document with several repositories
    assert found == secret_twin(rows, *limits)
