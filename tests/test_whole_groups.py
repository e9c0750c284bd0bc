"""Registered queries that digest whole groups: all texts of a day in order, not only their own hashes."""

import hashlib

import __spark_entry__ as entry

TEXTS = {0: "beta", 30: None, 60: "alpha", 90: "", 1: None, 31: None, 2: "gain rise", 32: "loss fall", 62: "gain fall"}


def _tables(spark, folder):
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang") \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(2, 1), (32, 0), (62, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def _digests():
    days = {}
    for i in sorted(TEXTS):
        days.setdefault(i % 30, []).append(TEXTS[i])
    joined = {d: [t for t in own if t is not None] for d, own in days.items()}
    return {d: (len(own), hashlib.md5("\x1f".join(joined[d]).encode()).hexdigest() if joined[d] else None) for d, own in days.items()}


def test_group_collect_digests_the_texts_of_a_day(spark, tmp_path):
    got = entry.queries()["group_collect"](spark, _tables(spark, tmp_path)).collect()
    assert {r["date"].day - 1: (r["n_items"], r["items_md5"]) for r in got} == _digests()


def test_group_score_mean_digests_the_texts_of_a_day(spark, tmp_path):
    got = {r["date"].day - 1: r for r in entry.queries()["group_score_mean"](spark, _tables(spark, tmp_path)).collect()}
    assert {d: r["news_md5"] for d, r in got.items()} == {d: m for d, (_, m) in _digests().items()}
    assert got[0]["mean_sentiment_score"] is None and got[2]["mean_sentiment_score"] is not None
