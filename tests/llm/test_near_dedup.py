import math
import random
import re
from collections import Counter

import numpy as np

from tessera.llm import near_dedup as N

from .cases import AWKWARD, docs_frame


def shingles(text):
    words = re.findall(r"[^\W_]+", text.lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def brute(rows, threshold=0.8, damping=0.25):
    """Groups by all pairs; rows are (id, text)."""
    sets = [shingles(t or "") for _, t in rows]
    docs = Counter(s for own in sets for s in own)
    n = len(rows)
    idf = {s: 1 + damping * math.log(n / d) / math.log(n + 1) for s, d in docs.items()}
    head = list(range(n))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            least = sum((1 + damping * math.log(min(a[s], b[s]))) * idf[s] for s in a if s in b)
            most = sum((1 + damping * math.log(max(a[s], b[s]))) * idf[s] for s in a | b)
            if rows[i][0] is not None and rows[j][0] is not None and (rows[i][0] == rows[j][0] or least and least / most >= threshold):
                head[top(i)] = top(j)
    least_id = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least_id[top(i)] = min(key, least_id.get(top(i), key))
    return sorted(((key, least_id.get(top(i))) for i, (key, _) in enumerate(rows)), key=str)


def corpus(seed, families=12, single=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    out = [" ".join(text(rng.randint(5, 150))) for _ in range(single)]
    for f in range(families):
        base = text(rng.randint(30, 200))
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    common = " ".join(text(30))
    out += [common + " " + " ".join(text(20)) for _ in range(30)]  # a passage that many share
    rng.shuffle(out)
    return out + out[:9]


def groups(rows):
    return sorted(((r.doc_id, r.group_id) for r in rows), key=str)


def test_groups_against_all_pairs(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        rows = N.near_duplicates(docs_frame(spark, texts), many=4, chunk=5).collect()
        assert groups(rows) == brute(list(enumerate(texts)))
        assert all(r.kept == (r.doc_id == r.group_id) for r in rows)


def test_a_repeated_line_does_not_make_texts_alike(spark):
    rng = random.Random(7)
    line = " ".join(f"l{i}" for i in range(12)) + "\n"
    texts = [line * 40 + " ".join(f"w{rng.randrange(10**6)}" for _ in range(150)) for _ in range(30)]
    assert all(r.kept for r in N.near_duplicates(docs_frame(spark, texts)).collect())


def test_awkward_rows(spark):
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(AWKWARD)]
    got = N.near_duplicates(docs_frame(spark, AWKWARD)).collect()
    assert groups(got) == brute(rows)
    assert all(r.kept for r in got if r.doc_id is None or r.doc_id in (0, 1, 2, 3))
    assert N.near_duplicates(docs_frame(spark, AWKWARD).limit(0)).collect() == []


def test_dropping_keeps_columns_and_one_row(spark):
    texts = corpus(3, families=4, single=10)
    docs = docs_frame(spark, texts + AWKWARD)
    kept = N.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    want = {r.doc_id for r in N.near_duplicates(docs).collect() if r.kept}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == want
    assert sum(r.doc_id is None for r in rows) == 2
    assert len({(r.doc_id, r.text) for r in rows}) == sum(r.doc_id is not None for r in rows) + 1
    wide = sorted(map(str, N.drop_near_duplicates(docs, broadcast_rows=0).collect()))
    assert wide == sorted(map(str, rows))


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = []
    for _ in range(700):
        own = list(base)
        own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    got = N.near_duplicates(docs_frame(spark, texts), chunk=64).collect()
    assert {r.group_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_blocks_hold_no_class_of_the_largest_component_for_its_own(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = []
    for _ in range(300):
        own = list(base)
        own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    ends = [[f"{c}{i}v{j}" for j in range(40)] for c in "yz" for i in range(5)]
    texts += [" ".join(base[:40] + a + b) for a in ends[:5] for b in ends[5:]]  # a third of the words, not near to any
    written = {}

    def kept(df, name):
        written[name] = materialized(df, name)
        return written[name]

    materialized = N.materialize
    monkeypatch.setattr(N, "materialize", kept)
    docs = docs_frame(spark, texts)
    got = N.near_duplicates(docs, chunk=8, bands=8, rows=1).collect()  # short codes, so that buckets hold several components
    assert groups(got) == brute(list(enumerate(texts)))
    rows = written["near-blocks"].groupBy("band", "code").count().collect()
    # 325 classes in chunks of 8: about 41 rows of each where all meet all
    assert rows and 300 < max(r["count"] for r in rows) < 10 * 325


def test_a_class_goes_to_a_block_only_where_a_pair_is_left(spark, monkeypatch):
    rng = random.Random(14)
    texts = []
    for f in range(12):
        base = [f"w{f}v{rng.randrange(10_000)}" for _ in range(100)]
        for i in range(6):  # each shares enough with the others, no two are near
            own = list(base)
            for at in (8 * i, 8 * i + 7):
                own[at + 10] = f"x{f}y{i}z{at}"
            texts.append(" ".join(own))
    written = {}

    def kept(df, name):
        written[name] = materialized(df, name)
        return written[name]

    materialized = N.materialize
    monkeypatch.setattr(N, "materialize", kept)
    got = N.near_duplicates(docs_frame(spark, texts), threshold=0.8, bands=20, rows=1).collect()
    assert groups(got) == brute(list(enumerate(texts)))
    placed, rows = written["near-places"].collect(), written["near-blocks"].collect()
    codes = {r.rep: r.codes for r in written["near-classes"].collect()}
    asked = Counter()
    needed = set()
    for r in placed:
        for q in placed:
            if (r.band, r.code, r.c1, r.c2) == (q.band, q.code, q.c1, q.c2) and r.rep < q.rep and r.component != q.component \
                    and min(r.own, q.own) < r.few and (r.own != q.own or r.c2 == r.few):
                if not any(x == y for x, y in zip(codes[r.rep][:r.band], codes[q.rep][:r.band])):
                    asked[r.rep, q.rep] += 1
                    needed |= {(r.band, r.code, r.c1, r.c2, r.rep), (r.band, r.code, r.c1, r.c2, q.rep)}
    assert asked and max(asked.values()) == 1  # each pair in its first band alone
    assert {(r.band, r.code, r.c1, r.c2, r.rep) for r in rows} == needed and len(rows) == len(needed)
    assert 2 * len(rows) < len(placed)


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    codes = np.sort(rng.integers(0, 1 << 56, 300).astype(np.uint64))
    a = rng.gamma(2, 1, 300) + 0.01
    b = a * np.exp(rng.normal(0, 0.4, 300))
    both = N.weighted_samples(np.concatenate([codes, codes[50:]]), np.concatenate([a, b[50:]]), np.array([0, 300]), 3000)
    want = np.minimum(a, np.append(np.zeros(50), b[50:])).sum() / np.maximum(a, np.append(np.zeros(50), b[50:])).sum()
    assert abs((both[0] == both[1]).mean() - want) < 0.04


def test_packing_round_trip():
    rng = np.random.default_rng(6)
    codes = np.sort(rng.integers(0, 1 << 56, 1000).astype(np.uint64))
    a, b = rng.integers(0, 1 << 32, 1000), rng.integers(0, 9, 1000)
    got = N.unpack(N.pack(codes, a, b), 1000, 2)
    assert all((x == y).all() for x, y in zip(got, (codes, a, b)))
