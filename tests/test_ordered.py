"""Ordered operators: golden cases and bucketed == global window."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import ordered as O


def _series(spark, n=200, seed=1, null_rate=0.2):
    rnd = random.Random(seed)
    rows = []
    for k in ("a", "b"):
        for i in range(n):
            v = None if rnd.random() < null_rate else round(rnd.uniform(-5, 5), 3)
            rows.append((k, dt.date(2024, 1, 1) + dt.timedelta(days=i), v))
    return spark.createDataFrame(rows, "k string, date date, v double")


def test_gap_segment_average_golden(spark):
    # worked example: scores .1-.7, prices 1 - - 4 5 - -
    rows = [(i, dt.date(2025, 1, 1) + dt.timedelta(days=i), s, p) for i, (s, p) in
            enumerate([(0.1, 1.0), (0.2, None), (0.3, None), (0.4, 4.0), (0.5, 5.0), (0.6, None), (0.7, None)])]
    df = spark.createDataFrame(rows, "i int, date date, score double, price double")
    out = O.gap_segment_average(df, "score", "price", name="avg", bucket="week").orderBy("i").toPandas()
    assert [round(x, 6) for x in out["avg"]] == [0.1, 0.3, 0.3, 0.3, 0.5, 0.65, 0.65]


def test_bucketed_matches_global(spark):
    df = _series(spark)
    pdf = df.toPandas().sort_values(["k", "date"])
    g = pdf.groupby("k")["v"]
    want_lag3 = g.shift(3)
    want_lead2 = g.shift(-2)
    want_bfill = g.bfill()
    # week buckets of 7 rows: lags of 3 and leads of 2 cross bucket edges constantly
    got = O.shift(df, {"lag3": ("v", 3), "lead2": ("v", -2)}, keys=["k"], order="date", bucket="week")
    got = got.toPandas().sort_values(["k", "date"])
    pd.testing.assert_series_equal(got["lag3"].reset_index(drop=True), want_lag3.reset_index(drop=True), check_names=False)
    pd.testing.assert_series_equal(got["lead2"].reset_index(drop=True), want_lead2.reset_index(drop=True), check_names=False)
    bf = O.backfill(df, ["v"], keys=["k"], order="date", bucket="week").toPandas().sort_values(["k", "date"])
    pd.testing.assert_series_equal(bf["v"].reset_index(drop=True), want_bfill.reset_index(drop=True), check_names=False)


def test_lag_crosses_small_buckets(spark):
    # buckets (one per day) smaller than the lag: values come from several buckets back
    df = _series(spark, n=40, null_rate=0.0)
    got = O.shift(df, {"lag5": ("v", 5)}, keys=["k"], order="date", bucket="day").toPandas().sort_values(["k", "date"])
    want = df.toPandas().sort_values(["k", "date"]).groupby("k")["v"].shift(5)
    assert got["lag5"].reset_index(drop=True).equals(want.reset_index(drop=True))


def test_positions_and_split(spark):
    df = _series(spark, n=101)
    out = O.chronological_split(df, keys=["k"], order="date", bucket="week").toPandas()
    for _, g in out.groupby("k"):
        g = g.sort_values("date")
        assert (g["split"] == "train").sum() == int(101 * 0.6)
        assert (g["split"] == "val").sum() == int(101 * 0.2)
        assert list(g["split"].iloc[:60].unique()) == ["train"]
    ri = O.row_index(df, keys=["k"], order="date", bucket="week").toPandas()
    for _, g in ri.groupby("k"):
        assert sorted(g["row_index"]) == list(range(1, 102))


def test_running_count_matches_cumsum(spark):
    df = _series(spark, n=60)
    out = O.running_count(df, F.col("v").isNotNull(), "c", keys=["k"], order="date", bucket="week")
    out = out.toPandas().sort_values(["k", "date"])
    for _, g in out.groupby("k"):
        want = g["v"].notna().astype(int).cumsum().shift(1, fill_value=0)
        assert list(g["c"]) == list(want)
