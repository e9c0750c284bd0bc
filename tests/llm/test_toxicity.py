import random
import zlib

import numpy as np

from tessera.llm import toxicity

from .cases import AWKWARD, docs_frame

WORDS = "alpha bravo candle delta echo forest garden hotel island jolly kettle lemon meadow north ocean".split()
BAD = ["wretchful", "grimblast", "snarkhole"]


def corpus(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        own = [rng.choice(WORDS) for _ in range(rng.randint(5, 120))]
        if i % 3 == 0:
            for _ in range(1 + len(own) // 60):
                own[rng.randrange(len(own))] = rng.choice(BAD)
        texts.append(" ".join(own))
        labels.append(int(i % 3 == 0))
    return texts, np.array(labels)


def test_few_words_and_misspellings_are_found():
    texts, labels = corpus(600, 1)
    model = toxicity.train(texts, labels, bits=14, updates=150)
    texts, labels = corpus(300, 2)
    found = toxicity.margins(model, texts) >= np.log(0.7 / 0.3)
    assert (found == labels).mean() > 0.98
    unseen = ["the meadow wretchfull north", "ocean grimmblast forest", "snarkholes in the garden"]
    assert (toxicity.margins(model, unseen) > toxicity.margins(model, ["the meadow careful north", "ocean forest", "in the garden"])).all()
    assert toxicity.margins(model, unseen).min() > 0
    long = " ".join(WORDS * 500)
    plain, bad = toxicity.margins(model, [long, long[:9000] + " wretchful grimblast " + long[9000:]])
    assert plain < 0 < bad


def test_scores_do_not_depend_on_the_batch():
    texts, labels = corpus(120, 3)
    model = toxicity.train(texts, labels, bits=12, updates=30)
    odd = [(t[1] if isinstance(t, tuple) else t) or "" for t in AWKWARD] + texts
    whole = toxicity.margins(model, odd)
    assert np.allclose(whole, [toxicity.margins(model, [t])[0] for t in odd], atol=1e-9)
    assert whole[1] == model.bias


def test_query(spark):
    texts, labels = corpus(300, 4)
    docs = docs_frame(spark, texts + [t[1] if isinstance(t, tuple) else t for t in AWKWARD] + [(None, "no id")])
    rows = spark.createDataFrame([(i, int(v)) for i, v in enumerate(labels)] + [(0, int(labels[0])), (None, 1), (5000, 1)], "doc_id long, toxic int")
    got = toxicity.detect_toxicity(docs, rows).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9
    assert toxicity.detect_toxicity(docs.limit(0), rows).collect() == []
    assert {r.predicted for r in toxicity.detect_toxicity(docs, rows.limit(0)).collect()} == {0}


def test_held_out_labels_have_no_say(spark):
    texts, labels = corpus(90, 5)
    docs = docs_frame(spark, texts)
    def scores(flip):
        rows = [(i, int(v) if zlib.crc32(str(i).encode()) % 3 != 1 or not flip else 1 - int(v)) for i, v in enumerate(labels)]
        return sorted(map(tuple, toxicity.detect_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int")).collect()))
    assert scores(False) == scores(True)


def test_a_label_of_long_texts_alone_is_learned(spark):
    """Toxic texts that are all longer than a stretch still teach, and an id with both labels counts as toxic."""
    rng = random.Random(6)
    plain = [" ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(120)]
    bad = [" ".join(rng.choice(WORDS + BAD) for _ in range(900)) for _ in range(60)]
    docs = docs_frame(spark, plain + bad)
    rows = [(i, int(i >= 120)) for i in range(180)] + [(130, 0)]
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), longest=3000)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum(got[i] == (i >= 120) for i in range(180)) >= 175
    sample = toxicity.labelled_sample(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), "toxic", 30, 10 ** 9, 3000)
    assert (sample.groupby("_label").size() == 30).all() and sample["_text"].str.len().max() == 3000
    few = toxicity.labelled_sample(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), "toxic", 10 ** 6, 1, 3000)
    assert set(few["_label"]) == {0, 1} or len(few) == 0
