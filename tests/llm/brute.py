"""Plain Python versions of the operators, for small fixtures."""

import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text, lower=False):
    text = text or ""
    return [w for w in SPACE.split(text.translate(UP) if lower else text) if w]


def shingles(text, n):
    w = words(text, True)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {("few", *w)}


def near_components(docs, n, percent):
    """docs: {doc_id: text}; {doc_id: smallest id reachable}."""
    sets = {i: shingles(t, n) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i in ids}


def dedup_lines(docs, min_chars=20, min_docs=3):
    """docs: {doc_id: text}; {doc_id: (lines, dropped, text)}."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UP)
    lines = {i: (t or "").split("\n") for i, t in docs.items()}
    holders = {}
    for i, own in lines.items():
        for x in own:
            holders.setdefault(key(x), set()).add(i)
    out = {}
    for i, own in lines.items():
        kept = [x for x in own if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and i != max(holders[key(x)]))]
        out[i] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def remove_repeats(rows, window):
    """rows: texts; (words, removed, kept text) of each."""
    ws = [words(t) for t in rows]
    seen = {}
    for w in ws:
        for s in range(len(w) - window + 1):
            g = tuple(w[s:s + window])
            seen[g] = seen.get(g, 0) + 1
    out = []
    for w in ws:
        gone = {p for s in range(len(w) - window + 1) if seen[tuple(w[s:s + window])] > 1 for p in range(s, s + window)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def contained(docs, items, n=5, percent=80):
    """{(doc_id, item_id): shared}, items of one set under the smallest id."""
    sets = {}
    for i, t in sorted(items.items()):
        s = frozenset(shingles(t, n))
        if s:
            sets.setdefault(s, i)
    out = {}
    for d, t in docs.items():
        own = shingles(t, n)
        for s, i in sets.items():
            if 100 * len(own & s) >= percent * len(s):
                out[d, i] = len(own & s)
    return out
