"""The corpus pipeline against a brute-force version of every stage, on a small fixture."""

import random
from collections import Counter

import corpus_pipeline
from tessera.llm import mixing, near_dedup, packing, passages, toxicity
from tessera.llm.common import materialize

from .cases import docs_frame
from .test_near_dedup import brute
from .test_toxicity import BAD, WORDS


def made():
    rng = random.Random(8)
    vocabulary = WORDS + [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in WORDS]
    texts, labels = [], []
    shared = [rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(70)]
    for i in range(240):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(8, 60))]
        if i % 5 == 0:
            own[rng.randrange(len(own))] = rng.choice(BAD)
        if i % 12 == 1:
            own += shared + [rng.choice(vocabulary) for _ in range(60)]
        texts.append(" ".join(own))
        labels.append(int(i % 5 == 0))
    copies = [3, 3, 7, 11, 22, 33]
    texts += [texts[i] for i in copies]
    labels += [labels[i] for i in copies]
    return texts + [None, "", "word"], labels


def test_stages(spark, tmp_path):
    texts, labels = made()
    docs = docs_frame(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, now, str(tmp_path)), f"test-{name}")
        seen.append((name, now, after))
        if name != "packing":
            assert after.columns == docs.columns
        now = after
    steps = {name: (before, after) for name, before, after in seen}

    before, after = steps["toxicity"]
    kept = {r.doc_id for r in after.collect()}
    bad = {i for i, v in enumerate(labels) if v}
    assert len(bad & kept) <= 2 and len(set(range(len(texts))) - bad - kept) <= 3

    before, after = steps["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {i for i, g in brute(rows) if i == g}

    before, after = steps["passages"]
    a, b = ({r.doc_id: r.text for r in x.collect()} for x in (before, after))
    assert set(a) == set(b)
    holders = [i for i, t in a.items() if t and i % 12 == 1]
    shared = " ".join(a[holders[0]].split(" ")[-130:-60])
    assert [i for i, t in b.items() if t and shared in t] == [min(holders)] or sum(bool(t) and shared in t for t in b.values()) == 1
    assert all(a[i] == b[i] for i in a if i not in holders)

    before, after = steps["mixing"]
    want = Counter(r.doc_id for r in mixing.mix_sources(before).collect())
    assert Counter(r.doc_id for r in after.collect()) == want and set(want) <= {r.doc_id for r in before.collect()}

    before, after = steps["packing"]
    rows = after.collect()
    whole = Counter()
    for r in packing.token_pieces(before).collect():
        whole[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == whole
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(rows)


def test_empty_documents(spark, tmp_path):
    docs = docs_frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_modules_are_those_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "passages", "mixing", "packing"]
    assert all(m.__name__.startswith("tessera.llm") for m in (toxicity, near_dedup, passages, mixing, packing))
