"""Scoring with a model that is loaded once a task, against a loop; digests of groups in parts."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import panel as P
from tessera.operators import text as TX


def test_scores_equal_a_loop(spark):
    rng = np.random.default_rng(6)
    texts = [[f"w{rng.integers(40)}" for _ in range(n)] for n in rng.integers(0, 60, 70)] + [None, [], ["x"] * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, tokens array<string>").repartition(3)
    weights, b = rng.normal(size=64), 0.2

    def plain(words, every):
        import zlib
        if not words:
            return None
        parts = [words[i:i + 8] for i in range(0, len(words), 8)] if every else [words[:8]]
        scores = [np.tanh((b + np.mean([weights[zlib.crc32(w.encode()) % 64] for w in p])) / 2) for p in parts]
        return float(np.average(scores, weights=[len(p) for p in parts]))

    for every in (False, True):
        got = TX.score_with_model(df, "id", TX.word_model(spark, weights, b), window=8, every=every, budget=100).collect()
        for r in got:
            want = plain(texts[r["id"]], every)
            assert (r["score"] is None) == (want is None) and (want is None or abs(r["score"] - want) < 1e-12)


def test_the_model_is_loaded_once_a_task_and_calls_are_alike(spark):
    df = spark.createDataFrame([(i, ["w"] * (1 + i % 40)) for i in range(400)], "id long, tokens array<string>").repartition(2)

    def load():
        loads = np.random.randint(1 << 30)  # the same number in all calls of a load

        def model(windows):
            longest = max(map(len, windows))
            assert len(windows) * longest <= 64 or len(windows) == 1
            assert min(map(len, windows)) * 2 >= longest or longest < 12
            return np.full(len(windows), float(loads))
        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = TX.score_with_model(df, "id", load, budget=64).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count_distinct("score").alias("n"))
        assert [r["n"] for r in got.collect()] == [1, 1]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_fitted_model_tells_words_apart(spark):
    rows = [(i, ("gain rise " if i % 2 else "loss fall ") * 3 + f"filler{i % 7}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    w, b = TX.fit_word_model(df.select("doc_id", "text"), df.filter("doc_id < 150").select("doc_id", "quality"), size=256)
    toks = TX.tokens_of(df, "text")
    got = TX.score_with_model(toks, "doc_id", TX.word_model(spark, w, b)).filter("doc_id >= 150").collect()
    assert len(got) == 50 and all((r["score"] > 0) == (r["quality"] == 1) for r in got)


def test_a_lexicon_beyond_the_limit_is_joined(spark):
    df = spark.createDataFrame([(1, "good good bad"), (2, "none"), (3, None)], "doc_id long, text string")
    lex = spark.createDataFrame([("good", 1.0), ("bad", -0.5)], "word string, weight double")
    for limit in (0, 10):
        got = {r["doc_id"]: r["score"] for r in TX.score_texts(df, "doc_id", lexicon=lex, broadcast_words=limit).collect()}
        assert got == {1: 0.5, 2: None, 3: None}


def test_parts_digest(spark):
    rows = [(None if i % 5 == 0 else i % 2, i, None if i % 9 == 0 else f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, id long, v string")
    items = P.group_collect(df, "k", "v", ["id"])
    got = {r["k"]: r["d"] for r in P.parts_digest(items, "k", "items", "d", part=4).collect()}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    for k in (None, 0, 1):
        own = ["" if v is None else md5(v) for kk, _, v in rows if kk == k]
        assert got[k] == md5("".join(md5("".join(own[i:i + 4])) for i in range(0, len(own), 4)))


def test_only_a_calls_tokens_are_python_objects(spark):
    df = spark.createDataFrame([(i, ["token"] * 8) for i in range(2000)], "id long, tokens array<string>").coalesce(1)

    def load():
        import gc
        return lambda windows: np.full(len(windows), float(sum(type(o) is list and len(o) == 8 and o[0] == "token" for o in gc.get_objects())))

    held = [r["score"] for r in TX.score_with_model(df, "id", load, window=8, budget=800).collect()]
    assert len(held) == 2000 and max(held) <= 200
