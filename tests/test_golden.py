"""Golden facts read off the reference's recorded artefacts and fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import drift as DR
from tessera.operators.forecast import ensemble_mean
from tessera.operators.panel import incremental_upsert, rank_models


def _fc(spark, vals):
    names = ["ARIMA", "GBM", "Lasso", "trend", "VAR", "last_value"]
    return spark.createDataFrame([("x", n, float(v)) for n, v in zip(names, vals)], "series string, name string, forecast double")


def test_ensemble_mean_golden(spark):
    new = _fc(spark, [24885.09, 24962.78, 25003.914065991274, 24681.91, 24898.41, 24888.2])
    ref = _fc(spark, [25142.0, 25591.15, 25210.734384456344, 24667.46, 25131.89, 25141.4])
    assert ensemble_mean(new, ["series"]).first()["forecast"] == 24886.42
    assert ensemble_mean(ref, ["series"]).first()["forecast"] == 25148.65


def test_direction_gate_golden(spark):
    rows = [("new", "model", 25003.91), ("new", "average_expected", 24886.42), ("new", "last_value", 24888.2),
            ("ref", "model", 25210.73), ("ref", "average_expected", 25148.65), ("ref", "last_value", 25141.4),
            ("gap", "model", 1.0)]
    df = spark.createDataFrame(rows, "series string, name string, forecast double")
    got = {r["series"]: r["direction_gate"] for r in DR.direction_gate(df).collect()}
    assert got == {"new": False, "ref": True, "gap": False}


def test_model_drift_and_score_gate(spark):
    prev = spark.createDataFrame([("m", 0.9233814096659101)], "series string, test_adjusted_r2 double")
    cur = spark.createDataFrame([("m", 0.9230313940042492)], "series string, test_adjusted_r2 double")
    assert DR.model_drift(prev, cur).first()["model_drift"] is False
    met = spark.createDataFrame([("m", s, r2, a) for s, r2, a in
                                 [("train", 0.9939, 0.9937), ("val", 0.9832, 0.98), ("test", 0.9304, 0.9230)]],
                                "series string, split string, r2 double, adjusted_r2 double")
    assert DR.score_gate(met).first()["score_gate"] is True
    assert DR.score_gate(met.filter("split != 'val'")).first()["score_gate"] is False


def test_rank_models_golden(spark):
    rep = spark.createDataFrame([("XGBRegressor", -0.6561), ("Ridge", 0.9197), ("Lasso", 0.9222), ("none", None)],
                                "model string, test_adj_r2 double")
    assert [r["model"] for r in rank_models(rep).collect()] == ["Lasso", "Ridge", "XGBRegressor", "none"]


def test_ks_hand_case(spark):
    a = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5]], "x double")
    b = spark.createDataFrame([(float(x),) for x in [3, 4, 5, 6, 7, 8]], "x double")
    r = DR.ks_statistics(a, b, ["x"]).first()
    assert abs(r["d"] - 0.5) < 1e-12
    assert 0 < r["p_value"] <= 1


def test_text_cases(spark):
    df = spark.createDataFrame([("Nifty UP 5%! see https://a.b/c now",), ("Investing.com -- Gold",)], "t string")
    got = [r[0] for r in df.select(X.clean_text(F.col("t"))).collect()]
    assert got == ["nifty up 5% see  now", "investingcom -- gold"]
    noise = spark.createDataFrame([("x investingcom -- gold rises",), ("reuters - a reuters - b",), ("indians buy gold",),
                                   ("plain",)], "t string")
    got = [r[0] for r in noise.select(X.remove_noise(F.col("t"))).collect()]
    assert got == ["gold rises", "a reuters - b", "buy gold", "plain"]
    toks = spark.createDataFrame([("nifty up 5% -- cannot stop",)], "t string").select(X.tokenize(F.col("t"))).first()[0]
    assert toks == ["nifty", "up", "5", "%", "--", "can", "not", "stop"]


def test_ticker_sample_upsert(spark):
    cols = ["nasdaq", "dj30", "sp500", "gold", "crude_oil", "usd_inr", "nsebank", "10yb", "vix", "nsei"]
    raw = [("2025-06-13", [19406.83, 42197.79, 5976.97, 3431.2, 72.98, 85.6884, 55527.35, 4.424, 20.82, 24718.6]),
           ("2025-06-14", [None] * 10), ("2025-06-15", [None] * 10),
           ("2025-06-16", [19701.21, 42515.09, 6033.11, 3396.4, 71.77, 86.2492, 55944.9, 4.452, 19.11, 24946.5]),
           ("2025-06-17", [19521.09, 42215.8, 5982.72, 3386.6, 74.84, 86.1042, 55714.15, 4.393, 21.6, 24853.4]),
           ("2025-06-18", [19546.27, 42171.66, 5980.87, 3389.8, 75.14, 86.3627, 55828.75, 4.397, 20.14, 24812.05]),
           ("2025-06-19", [None, None, None, None, None, 86.6136, 55577.45, None, None, 24793.25])]
    schema = "date string, " + ", ".join(f"`{c}` double" for c in cols) + ", __batch int, __pos_in long"
    rows = [(d, *v, 1, i) for i, (d, v) in enumerate(raw)]
    new = spark.createDataFrame(rows, schema).withColumn("date", F.to_date("date"))
    old = new.limit(0)
    out = incremental_upsert(old, new, date="date", main="nsei").orderBy("date").toPandas()
    assert len(out) == 5
    last = out.iloc[-1]
    assert last["usd_inr"] == 86.61
    assert sum(last[c] != last[c] or last[c] is None for c in cols) == 7
