"""One-step forecasts against closed forms in numpy; text orders; ties; checks that raise; the date step."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import forecast as FC
from tessera.operators import ordered as O
from tessera.operators import panel as P
from tessera.operators import quality as Q
from tessera.plans.feature_queries import preprocess_chain


def series(spark, n=160, seed=3):
    rng = np.random.default_rng(seed)
    y = 1000 + np.cumsum(rng.normal(size=n)) + 5 * np.sin(np.arange(n) * 2 * np.pi / 7)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    return spark.createDataFrame(list(zip(days, map(float, y))), "date date, value double").repartition(3), days, y


def test_ar_is_least_squares_on_differences(spark):
    df, _, y = series(spark)
    d = np.diff(y)
    X = np.column_stack([d[5 - i:len(d) - i] for i in range(1, 6)])
    phi = np.linalg.lstsq(X, d[5:], rcond=None)[0]
    want = y[-1] + phi @ d[::-1][:5]
    assert FC.ar_forecast(df, "value").first()["forecast"] == pytest.approx(want, abs=0.0051)


def test_var_takes_the_order_of_least_aic(spark):
    df, days, y = series(spark)
    most, z = 6, np.column_stack([y, [d.weekday() for d in days]]).astype(float)
    best = None
    Y = z[most:]
    for p in range(1, most + 1):
        X = np.column_stack([np.ones(len(Y)), *(z[most - i:len(z) - i] for i in range(1, p + 1))])
        B = np.linalg.lstsq(X, Y, rcond=None)[0]
        S = (Y - X @ B).T @ (Y - X @ B) / len(Y)
        aic = np.log(np.linalg.det(S)) + 2 * 2 * (2 * p + 1) / len(Y)
        if best is None or aic < best[0]:
            best = (aic, p, np.concatenate([[1.0], *(z[-i] for i in range(1, p + 1))]) @ B[:, 0])
    got = FC.var_forecast(df, "value", max_lags=most).first()
    assert got["lag_order"] == best[1] and got["forecast"] == pytest.approx(best[2], abs=0.02)


def test_trend_is_a_ridge_on_hinges_and_waves(spark):
    df, days, y = series(spark)
    t = np.array([(d - dt.date(1970, 1, 1)).days for d in days], float)

    def features(day):
        u = (day - t[0]) / (t[-1] - t[0])
        waves = [f(2 * np.pi * k / period * day) for period, most in ((7, 2), (365.25, 3)) for k in range(1, most + 1) for f in (np.sin, np.cos)]
        return [1, u, *(max(u - 0.8 * j / 5, 0) for j in range(1, 5)), *waves]

    X = np.array([features(d) for d in t])
    lam = np.ones(X.shape[1])
    lam[0] = 0
    w = np.linalg.solve(X.T @ X + np.diag(lam), X.T @ y)
    got = FC.trend_seasonal_forecast(df, "value", n_changepoints=4, weekly=2, yearly=3).first()["forecast"]
    assert got == pytest.approx(np.array(features(t[-1] + 1)) @ w, abs=0.02)


def test_forecast_all_holds_all_and_their_mean(spark):
    df, _, y = series(spark)
    got = {r["name"]: r["forecast"] for r in FC.forecast_all(df, "value", z=0.0).collect()}
    assert set(got) == {"ARIMA", "GBM", "trend_seasonal", "VAR", "last_value", "average_expected"}
    assert got["last_value"] == y[-1]
    assert got["average_expected"] == pytest.approx(np.mean([v for k, v in got.items() if k not in ("last_value", "average_expected")]), abs=0.0051)


def test_text_orders_are_cut_by_their_own_order(spark, monkeypatch):
    """Text that is no time stamp, and mixed forms, fall into several buckets and keep the order of the text."""
    rng = np.random.default_rng(1)
    names = [f"{'abcxyz'[rng.integers(6)]}{rng.integers(10 ** 6)}" for _ in range(300)] + ["2024-01-05", "Jan 7, 2024", "2024-1-6"] + ["hot"] * 200
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i long").repartition(4)
    cuts = O.row_buckets(df, ["name", "i"], rows=40)
    assert df.select(cuts.alias("b")).groupBy("b").count().agg(F.count("b"), F.max("count")).first()[0] >= 8
    got = O.positions(df, [], ["name", "i"], bucket=cuts).orderBy(O.POS).collect()
    assert [(r["name"], r["i"]) for r in got] == sorted((n, i) for i, n in enumerate(names))


def test_ties_have_a_defined_winner(spark):
    rows = [("k", 1, "b", 2.0), ("k", 1, "c", 1.0), ("k", 1, "c", None), ("j", 0, "z", 0.0)]
    for part in (1, 3):
        df = spark.createDataFrame(rows, "key string, at int, s string, v double").repartition(part)
        assert sorted(tuple(r) for r in P.dedupe_keep_last(df, "key", "at").collect()) == [("j", 0, "z", 0.0), ("k", 1, "c", 1.0)]
        assert tuple(P.last_row(df, "at").first()) == ("k", 1, "c", 1.0)
    mapped = spark.createDataFrame([("k", 1, {"a": 1})], "key string, at int, m map<string,int>")
    assert P.dedupe_keep_last(mapped, "key", "at").first()["m"] == {"a": 1}


def test_checks_raise_when_asked(spark):
    day = dt.date(2024, 1, 1)
    good = spark.createDataFrame([(day, 0.5, 3.0)], "date date, mean_sentiment_score double, gold double")
    how = {"required": ["date", "gold"], "prices": ["gold"], "as_of": "2024-02-01", "fail_on_error": True}
    assert Q.run_all_checks(good, **how).isEmpty()
    with pytest.raises(ValueError, match="validation failed"):
        Q.run_all_checks(good.withColumn("gold", F.lit(-1.0)), **how)


def test_the_chain_parses_dates(spark):
    rng = np.random.default_rng(2)
    days = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(40)] + ["not-a-date", None]
    rows = [(d, *(float(v) for v in rng.normal(10, 1, 2))) for d in days]
    df = spark.createDataFrame(rows, "day string, purchase double, view double")
    got = preprocess_chain(df, order="day", impute_method="mean").orderBy("day").collect()
    assert len(got) == 39 and got[0]["day"] == dt.date(2024, 1, 2) and got[-1]["target"] is None
