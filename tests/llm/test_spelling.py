"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import spelling

from .cases import AWKWARD, docs_frame


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least_length=5, least_count=3, slip=97):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if slip and h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= least_count and len(w) >= least_length}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def found(docs, **how):
    return sorted(tuple(r) for r in spelling.spelling_variants(docs, **how).select(*COLUMNS).collect())


def noisy(seed, n=150):
    """Texts over few words with edits of all kinds, doubled letters and words that are parts of others."""
    rng = random.Random(seed)
    base = ["letter", "littler", "aaaaa", "aaaaaa", "better", "straße", "éééééé", "bookkeeper", "bokkeeper", "ÿellow", "mississippi"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(20):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + rng.choice("aelté") + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice("aelté") + w[at + 1:]])
            words.append(rng.choice([w, w.upper(), w.title()]))
        out.append(rng.choice([" ", ", ", "\n", "1"]).join(words))
    return out


@pytest.mark.parametrize("how", [{}, {"slip": 3}, {"slip": None, "least_length": 2, "least_count": 1}])
def test_equals_a_comparison_of_all_pairs(spark, how):
    texts = noisy(4)
    want = brute(list(enumerate(texts)), **how)
    assert found(docs_frame(spark, texts), **how) == want
    assert any(r[1] and r[1] != r[2] for r in want)


def test_awkward_rows(spark):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(AWKWARD)]
    docs = docs_frame(spark, AWKWARD)
    for how in ({}, {"least_length": 1, "least_count": 1, "slip": 2}):
        assert found(docs, **how) == brute(rows, **how)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_numbers_are_those_of_one_trie(spark):
    """However many ranges the words are dealt to, a prefix has one number and numbers follow the sorted order."""
    rng = random.Random(9)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))) for _ in range(400)}
    rows = spark.createDataFrame([(w,) for w in words], "word string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["word"]: r["path"] for r in spelling.number_nodes(rows, "word", "test-trie").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    nodes = {w[:i + 1]: x for w, path in got.items() for i, x in enumerate(path)}
    assert all(nodes[w[:i + 1]] == x for w, path in got.items() for i, x in enumerate(path))
    assert sorted(nodes.values()) == list(range(1, len(nodes) + 1)) and set(got) == words
    assert [nodes[p] for p in sorted(nodes)] == list(range(1, len(nodes) + 1))


def test_long_words(spark):
    long = "ab" * 4000
    texts = [long] * 3 + [long + "a"] * 6 + [long[:-1] + "c"] * 3
    assert found(docs_frame(spark, texts), slip=None) == brute(list(enumerate(texts)), slip=None)
