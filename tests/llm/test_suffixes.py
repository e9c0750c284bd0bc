"""Repeated byte strings against a plain count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffixes

from .cases import AWKWARD, docs_frame


def brute(texts, least):
    """(n_bytes, n_removed, n_spans, sha256 of what is kept) of each text, by counting every window."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + least] for r in raw for i in range(len(r) - least + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - least + 1):
            if seen[r[i:i + least]] > 1:
                gone[i:i + least] = True
        gone[-1] = False
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), len(r) - len(kept), int((np.diff(gone.astype(int)) == -1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(docs, least, **how):
    rows = suffixes.remove_repeats(docs, least=least, **how).collect()
    for r in rows:
        spans = sorted((s["start"], s["length"]) for s in r["spans"])
        assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) + len(r["kept"]) == r["n_bytes"]
    return sorted((r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in rows)


def planted(n, least, seed=1):
    """Random texts that share passages just below, at and over the length, edited copies and runs."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    shared = [word(least + d) for d in (-1, 0, 1, 40, 3 * least)]
    out = []
    for _ in range(n):
        text = word(rng.randrange(3 * least))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(shared) + text[at:]
        out.append(text)
    copy = list(word(6 * least))
    for _ in range(n // 3):
        own = copy[:]
        own[rng.randrange(len(own))] = "#"
        out.append("".join(own))
    return [*out, "x" * (4 * least), "xy" * (2 * least), out[0], out[0]]


@pytest.mark.parametrize("how", [{}, {"bucket": 2}, {"windows": 50, "bucket": 3, "seed": 5}, {"seed": 40}])
def test_equals_a_count_of_all_windows(spark, how):
    texts = planted(60, 40)
    assert found(docs_frame(spark, texts), 40, **{"seed": 12, **how}) == brute(texts, 40)


def test_awkward_rows(spark):
    texts = [t[1] if isinstance(t, tuple) else t for t in AWKWARD]
    docs = docs_frame(spark, AWKWARD)
    assert found(docs, 5, seed=3) == brute(texts, 5)
    assert suffixes.repeats_digest(docs.limit(0)).count() == 0
    got = suffixes.repeats_digest(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got.filter("n_removed = 0").count() == len(AWKWARD) - 3  # the runs of é, of x and of 'word '


def test_parts_of_a_long_text(spark):
    """Texts longer than a part: windows over the border, copies at other places of the parts."""
    body = "".join(random.Random(5).choices("abcdefgh ", k=2_600_000))
    passage = body[1_048_000:1_049_500]
    texts = [body, "q" * 7 + passage + "r", body[:100] + "z"]
    rows = {r["n_bytes"]: r for r in suffixes.remove_repeats(docs_frame(spark, texts)).collect()}
    assert [tuple(s) for s in rows[2_600_000]["spans"]] == [(1_048_000, 1500)]
    assert [tuple(s) for s in rows[1508]["spans"]] == [(7, 1500)] and rows[101]["spans"] == []


def test_a_passage_in_many_texts_is_divided(spark):
    """An anchor of many different spans goes over several buckets; the result is the same."""
    rng = random.Random(3)
    word = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    passage = word(90)
    texts = [word(60) + passage + word(60) for _ in range(300)]
    assert found(docs_frame(spark, texts), 60, seed=20, bucket=16) == brute(texts, 60)


def test_last_pass_is_needed():
    """Windows that differ in their last byte only are not equal."""
    data = np.frombuffer(b"a" * 99 + b"b" + b"a" * 99 + b"c" + b"a" * 99 + b"b", np.uint8)
    got = suffixes.sort_windows(data, np.array([0, 100, 200]), np.zeros(3, np.int64), 100)
    assert got.tolist() == [0, -1, 0]


def test_spans_cover_every_window():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    at = np.array([0, 30, 130, 131, 2000, 2050, 5000])
    start, count, *_ = suffixes.find_spans(data, at[:-1], at[1:], 50, 10)
    every = [s + i for s, c in zip(start, count) for i in range(c)]
    assert every == [i for a, b in zip(at[:-1], at[1:]) for i in range(a, b - 49)]
