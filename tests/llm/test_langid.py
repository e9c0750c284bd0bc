import random
import zlib

import numpy as np

from tessera.llm import langid

from .cases import AWKWARD, docs_frame

SYLLABLES = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "unt", "erg", "ö"], "zz": ["eau", "tio", "que", "é"]}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n, seed):
    rng = random.Random(seed)
    langs = [("xx", "yy", "zz")[i % 3] for i in range(n)]
    return [text(x, rng.randint(1, 80), rng) for x in langs], langs


def model():
    return langid.train(*corpus(300, 1), bits=12, chains=600, epochs=6, batch=200)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    scores, trans, first = rng.normal(size=(150, 3)), rng.normal(size=(3, 3)), np.array([0, 5, 5, 6, 100, 150])
    got = langid.marginals(scores, trans, first, block=8)
    for a, b in zip(first, first[1:]):
        if a == b:
            continue
        ahead = [np.exp(scores[a])]
        for t in range(a + 1, b):
            ahead.append((ahead[-1] @ np.exp(trans)) * np.exp(scores[t]))
        behind = [np.ones(3)]
        for t in range(b - 1, a, -1):
            behind.append(np.exp(trans) @ (np.exp(scores[t]) * behind[-1]))
        want = np.array(ahead) * np.array(behind[::-1])
        assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True), atol=1e-9)


def test_expected_pairs_are_exact():
    rng = np.random.default_rng(1)
    scores, trans = rng.normal(size=(2, 4, 2)), rng.normal(size=(2, 2))
    want = np.zeros((2, 2))
    for s in scores:
        paths = [[(p >> t) & 1 for t in range(4)] for p in range(16)]
        w = np.array([np.exp(sum(s[t, y[t]] for t in range(4)) + sum(trans[y[t], y[t + 1]] for t in range(3))) for y in paths])
        for y, x in zip(paths, w / w.sum()):
            for t in range(3):
                want[y[t], y[t + 1]] += x
    p = langid.marginals(scores.reshape(-1, 2), trans, np.array([0, 4, 8])).reshape(2, 4, 2)
    assert np.allclose(langid.expected_pairs(scores, trans, p), want)


def test_accuracy_and_code_switching(spark):
    m = model()
    texts, langs = corpus(240, 2)
    got, score = langid.predict(m, texts)
    assert np.mean([a == b for a, b in zip(got, langs)]) > 0.97 and (0 <= score).all() and (score <= 1).all()
    assert (np.diag(m.trans) > m.trans.mean()).all()
    rng = random.Random(3)
    mixed = docs_frame(spark, [text("xx", 30, rng) + " " + text("yy", 20, rng)])
    spans = sorted(langid.language_spans(mixed, m).collect(), key=lambda r: r.first_word)
    main = [r for r in spans if r.words >= 10]
    assert [r.lang for r in main] == ["xx", "yy"] and abs(main[1].first_word - 30) <= 2


def test_whole_texts_and_batches_agree():
    m = model()
    odd = [(t[1] if isinstance(t, tuple) else t) or "" for t in AWKWARD] + corpus(30, 4)[0] + [" ".join(corpus(300, 5)[0])]
    langs, score = langid.predict(m, odd)
    for t, x, s in zip(odd, langs, score):
        a, b = langid.predict(m, [t])
        assert a[0] == x and abs(b[0] - s) < 1e-6
    assert langs[:4] == ["und"] * 4 and score[0] == 0


def test_query(spark):
    texts, _ = corpus(200, 6)
    docs = docs_frame(spark, texts + AWKWARD)
    rows = langid.detect_languages(docs).collect()
    assert len(rows) == len(texts) + len(AWKWARD)
    for r in rows:
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert langid.detect_languages(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.detect_languages(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_a_language_of_long_texts_alone_is_learned(spark):
    import random

    from tessera.llm import langid

    rng = random.Random(3)
    words = {"xx": "ka lomi tuve sira pono".split(), "yy": "grund brett schlau witz kranz".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(900 if k == "yy" else 60)), k) for i, k in enumerate(["xx", "yy"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    assert model.langs == ["xx", "yy"] or list(model.langs) == ["xx", "yy"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.label_languages(docs, model).collect()}
    assert all(got[i] == k for i, _, k in rows)
