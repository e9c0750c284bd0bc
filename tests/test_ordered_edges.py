"""Ordered operators on null keys, null and tied dates, tiny buckets, hot dates, and their growth."""

import datetime as dt
import time

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import drift, ordered as O, panel as P


def frame(spark, n=120):
    """Series a, b and a null key; every ninth date is null; values have gaps."""
    rows = []
    for k in ("a", "b", None):
        for i in range(n):
            day = None if i % 9 == 4 else dt.date(2024, 1, 1) + dt.timedelta(days=i // 2)
            rows.append((k, day, i, None if i % 5 == 2 else float(i * (1 if k else 3))))
    return spark.createDataFrame(rows, "k string, date date, i int, v double")


def ordered(df):
    pdf = df.toPandas()
    pdf["k"] = pdf["k"].where(pdf["k"].notna(), "~")
    pdf["d"] = pd.to_datetime(pdf["date"]).astype("int64").where(pdf["date"].notna(), -(2**62))
    return pdf.sort_values(["k", "d", "i"]).reset_index(drop=True)


def buckets(df):
    yield "week"
    yield None
    yield O.row_buckets(df, ["date", "i"], rows=7)


def test_no_row_is_lost_and_values_match(spark):
    df = frame(spark)
    base = ordered(df)
    g = base.groupby("k")["v"]
    for b in buckets(df):
        got = ordered(O.shift(df, {"p": ("v", 3), "n": ("v", -2)}, keys=["k"], order=["date", "i"], bucket=b))
        assert len(got) == len(base)
        pd.testing.assert_series_equal(got["p"], g.shift(3), check_names=False)
        pd.testing.assert_series_equal(got["n"], g.shift(-2), check_names=False)
        got = ordered(O.backfill(df, ["v"], keys=["k"], order=["date", "i"], bucket=b))
        pd.testing.assert_series_equal(got["v"], g.bfill(), check_names=False)
        got = ordered(O.row_index(df, keys=["k"], order=["date", "i"], bucket=b))
        assert got["row_index"].tolist() == (base.groupby("k").cumcount() + 1).tolist()
        got = ordered(O.running_count(df, F.col("v").isNotNull(), "c", keys=["k"], order=["date", "i"], inclusive=True, bucket=b))
        assert got["c"].tolist() == base["v"].notna().groupby(base["k"]).cumsum().tolist()
        got = ordered(O.chronological_split(df, keys=["k"], order=["date", "i"], bucket=b))
        assert got.groupby(["k", "split"]).size().to_dict() == {(k, s): n for k in ("a", "b", "~") for s, n in (("train", 72), ("val", 24), ("test", 24))}
        got = ordered(O.gap_segment_average(df.withColumn("price", F.when(F.col("i") % 3 == 0, 1.0)), "v", "price", "m", ["k"], ["date", "i"], b))
        assert len(got) == len(base) and got["m"].notna().sum() > 300


def test_row_buckets_split_a_hot_date(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(day, i) for i in range(600)] + [(day + dt.timedelta(days=1 + i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, i int")
    sizes = df.withColumn("b", O.row_buckets(df, ["ts", "i"], rows=50)).groupBy("b").agg(F.count("*").alias("n"), F.min("ts"), F.min("i")).collect()
    assert max(r.n for r in sizes) <= 150 and len(sizes) >= 10
    got = O.row_index(df, order=["ts", "i"], bucket=O.row_buckets(df, ["ts", "i"], rows=50)).orderBy("ts", "i").collect()
    assert [r.row_index for r in got] == list(range(1, 801))


def upsert(spark, n):
    base = dt.datetime(2020, 1, 1)
    df = spark.range(n).select((F.lit(base) + F.make_interval(hours=F.col("id").cast("int"))).alias("date"), F.col("id").alias("__pos_in"),
                               (F.col("id") % 97).cast("double").alias("nsei"), F.when(F.col("id") % 50 == 0, 1.0).alias("gold"))
    old = df.where(f"__pos_in < {n * 2 // 3}").withColumn("__batch", F.lit(0))
    new = df.where(f"__pos_in >= {n // 2}").withColumn("__batch", F.lit(1))
    start = time.perf_counter()
    out = P.incremental_upsert(old, new)
    assert out.count() == n
    return time.perf_counter() - start


def test_back_fill_and_upsert_grow_about_linearly(spark):
    upsert(spark, 1_000)
    small, large = upsert(spark, 20_000), upsert(spark, 200_000)
    assert large < 10 * small + 20


def test_nan_scores_never_pass(spark):
    nan = float("nan")
    m = spark.createDataFrame([("s", x, nan, nan) for x in ("train", "val", "test")] + [("t", x, .95, .95) for x in ("train", "val", "test")],
                              "series string, split string, r2 double, adjusted_r2 double")
    assert {r.series: r.score_gate for r in drift.score_gate(m).collect()} == {"s": False, "t": True}
    a = spark.createDataFrame([("s", .9), ("t", nan)], "series string, test_adjusted_r2 double")
    b = spark.createDataFrame([("s", nan), ("t", .9)], "series string, test_adjusted_r2 double")
    assert not any(r.model_drift for r in drift.model_drift(a, b).collect())
    c = spark.createDataFrame([(0, nan, "x"), (1, .5, "y")], "i int, score double, model string")
    assert P.argmax_params(c, "score", "i").first().model == "y"
    assert [r.model for r in P.rank_models(c, "score").collect()] == ["y", "x"]


def test_ks_on_heavy_tails_and_nan(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x, y = rng.standard_cauchy(700) * 1e6, rng.standard_cauchy(500) * 1e6 + 2e5
    both = np.concatenate([x, y])
    want = max(abs((x <= v).mean() - (y <= v).mean()) for v in both)
    a = spark.createDataFrame([(float(v),) for v in x] + [(float("nan"),), (None,)], "v double")
    b = spark.createDataFrame([(float(v),) for v in y], "v double")
    got = drift.ks_statistics(a, b).first()
    assert (got.n_a, got.n_b) == (700, 500) and abs(got.d - want) < 1e-12
    hand = drift.ks_statistics(spark.createDataFrame([(float(v),) for v in range(1, 6)], "v double"),
                               spark.createDataFrame([(float(v),) for v in range(3, 9)], "v double")).first()
    assert abs(hand.d - 0.5) < 1e-12


def test_stamps_with_fractions_and_zones(spark):
    from tessera.functions.dates import parse_date_coerce
    texts = ["2024-01-01 10:00:00.123", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00.5", "2024-01-01", "Jan 1, 2024", "01-01-2024", "not-a-date", "10:00", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(parse_date_coerce(F.col("s"))).collect()]
    assert got == [dt.date(2024, 1, 1)] * 6 + [None] * 3
