"""Lemmas put in place row by row, against a plain loop and against the join; cleaning character by character."""

import re

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import text as TX

ROWS = [(1, ["cars", "car", "woman", "women", "s"]), (2, []), (3, None), (4, ["boxes", "box", "cities"]), (5, ["city", None, "cars"]),
        (None, ["cars"]), (6, ["cars", "city"]), (6, ["boxes"])]


def _plain(words):
    known = {w for _, own in ROWS for w in own or []} - {None}

    def lemma(w):
        bases = [(len(b), i, b) for i, (suf, rep) in enumerate(TX.NOUN_SUFFIX_RULES) if w and w.endswith(suf)
                 for b in [w[:len(w) - len(suf)] + rep] if b and b in known]
        return min(bases)[2] if bases else w
    return [lemma(w) for w in words or []]


def test_lemmas_in_rows_equal_the_join(spark):
    df = spark.createDataFrame(ROWS, "id long, tokens array<string>").repartition(3)
    whole = sorted((i, _plain(w)) for i, w in ROWS if i not in (None, 6))
    for limit in (1000, 0):
        got = [(r["id"], r["lemmas"]) for r in TX.lemmatize(df, "id", broadcast_words=limit).collect()]
        assert sorted(r for r in got if r[0] not in (None, 6)) == whole
        assert [r for r in got if r[0] is None] == [(None, [])]  # a null key joins nothing
        assert [r for r in got if r[0] == 6] == [(6, ["box", "car", "city"])] * 2  # rows of a key are read together, by position


def test_tokens_stay_in_their_rows(spark):
    df = spark.createDataFrame([r for r in ROWS if r[0] not in (None, 6)], "id long, tokens array<string>")
    plan = TX.lemmatize(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "posexplode" not in plan


def test_news_are_in_order_with_and_without_repeated_keys(spark):
    rows = [(i * 7 % 40, f"2024-01-{1 + i % 5:02d}" if i % 6 else None, f"Cars car {i}") for i in range(40)]
    for more in ([], [(3, "2024-01-02", "more cars")]):
        got = TX.news_clean(spark.createDataFrame(rows + more, "id long, date string, text string").repartition(4), "id").collect()
        assert [(r["date"], r["id"]) for r in got] == sorted((r["date"], r["id"]) for r in got)
        assert len(got) == sum(d is not None for _, d, _ in rows + more) and all("cars" not in r["joined_text"] for r in got)


def test_clean_text_keeps_what_it_kept(spark):
    text = "".join(map(chr, range(1, 0x250))) + " A-b+c%dK　  http://x.y z"
    got = spark.createDataFrame([(text,)], "t string").select(X.clean_text(F.col("t")).alias("c")).first()["c"]
    old = spark.createDataFrame([(text,)], "t string").select(
        F.regexp_replace(F.lower(F.regexp_replace("t", X.URL_PATTERN, "")), r"[^a-z0-9\-+%\s]", "").alias("c")).first()["c"]
    assert got == old and re.fullmatch(r"[a-z0-9\-+% \t\n\x0b\f\r]*", got)
