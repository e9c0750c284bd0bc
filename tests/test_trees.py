"""Boosted trees against a plain recursive build, and the two ways of fitting against each other."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import trees as TR

P = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}


def data(spark, n=500, seed=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[rng.random((n, 4)) < 0.05] = np.nan
    y = np.where(np.nan_to_num(x[:, 0]) > 0.3, 5.0, -1.0) + np.nan_to_num(x[:, 1]) ** 2 + rng.normal(scale=0.1, size=n)
    rows = [(i, *(None if v != v else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double").repartition(3), x, y


def plain(x, y, edges, p):
    """Trees by recursion over row lists, one split tried after the other."""
    bins = TR.to_bins(x, edges)
    pred = np.full(len(y), y.mean())

    def T(g):
        return np.sign(g) * max(abs(g) - p.get("reg_alpha", 0), 0)

    lam, gamma = p.get("reg_lambda", 1.0), p.get("gamma", 0)

    def build(idx, g, depth):
        own = {"w": -T(g[idx].sum()) / (len(idx) + lam)}
        best = (1e-6, None)
        if depth < p["max_depth"]:
            for f in range(x.shape[1]):
                for cut in range(bins[:, f].max() + 1):
                    lo, hi = idx[bins[idx, f] <= cut], idx[bins[idx, f] > cut]
                    if len(lo) < 1 or len(hi) < 1:
                        continue
                    gain = sum(T(g[s].sum()) ** 2 / (len(s) + lam) * k for s, k in ((lo, 1), (hi, 1), (idx, -1)))
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, lo, hi))
        if best[1]:
            f, cut, lo, hi = best[1]
            kids = build(lo, g, depth + 1), build(hi, g, depth + 1)
            if best[0] >= gamma or "f" in kids[0] or "f" in kids[1]:
                own |= {"f": f, "cut": cut, "kids": kids}
        return own

    def value(node, r):
        while "f" in node:
            node = node["kids"][int(r[node["f"]] > node["cut"])]
        return node["w"]

    for _ in range(p["n_estimators"]):
        tree = build(np.arange(len(y)), pred - y, 0)
        pred = pred + p["learning_rate"] * np.array([value(tree, r) for r in bins])
    return pred


@pytest.mark.parametrize("more", [{}, {"reg_alpha": 3.0}, {"reg_lambda": 20.0}, {"gamma": 30.0, "reg_alpha": 0.5}])
def test_equals_a_plain_build(spark, more):
    df, x, y = data(spark)
    model = TR.fit_trees(df, ["a", "b", "c", "d"], "y", P | more, rows=["id"], bins=16)
    want = plain(x, y, model["edges"], P | more)
    got = df.select("id", TR.predictor(model)("a", "b", "c", "d").alias("p")).orderBy("id").toPandas()["p"]
    assert np.allclose(got, want, atol=1e-9)


def test_regularisation_changes_leaves():
    p = TR.checked({"reg_alpha": 2.0, "reg_lambda": 3.0})
    assert TR.weight(-12.0, 7.0, p) == pytest.approx(10 / 10) and TR.weight(1.5, 7.0, p) == 0
    with pytest.raises(ValueError, match="unknown tree parameters"):
        TR.checked({"solver": "auto"})


def test_in_step_equals_one_task_each(spark):
    """Passes over all rows a level, with predictions written in between, give the same trees."""
    df, _, _ = data(spark, 300)
    sets = [P | m for m in ({}, {"n_estimators": 3}, {"subsample": 0.7, "colsample_bytree": 0.5}, {"max_depth": 2, "reg_alpha": 1.0},
                            {"n_estimators": 4, "gamma": 5.0})]
    params, where = TR.boosters(sets)
    assert len(params) == 4 and where[1] == (0, 3)
    edges = TR.bin_edges(df, ["a", "b", "c", "d"], 16)
    fitted = [TR.fit_boosters(df, ["a", "b", "c", "d"], "y", params, edges, ["id"], cells, keep=2).orderBy("booster").collect()
              for cells in (0, 10 ** 9)]
    for a, b in zip(*fitted):
        for s, t in zip(json.loads(a["trees"]), json.loads(b["trees"]), strict=True):
            assert s["feature"] == t["feature"] and s["cut"] == t["cut"] and np.allclose(s["value"], t["value"])


def test_scores_are_those_of_predictions(spark):
    df, _, _ = data(spark, 400)
    train, val = df.filter("id < 300"), df.filter("id >= 300")
    sets = [P, P | {"n_estimators": 2}, P | {"reg_alpha": 1.0}]
    got = {r["idx"]: r["val_r2"] for r in TR.search_trees(train, val, ["a", "b", "c", "d"], "y", sets, ["id"]).collect()}
    for i, s in enumerate(sets):
        model = TR.fit_trees(train, ["a", "b", "c", "d"], "y", s, rows=["id"])
        pdf = val.select("y", TR.predictor(model)("a", "b", "c", "d").alias("p")).toPandas()
        assert got[i] == pytest.approx(1 - ((pdf.y - pdf.p) ** 2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum())
    assert got[0] > got[1] > 0.3


def test_edges(spark):
    df, x, y = data(spark, 50)
    with pytest.raises(ValueError, match="no training row"):
        TR.fit_trees(df.withColumn("y", F.lit(None).cast("double")), ["a"], "y", P, rows=["id"])
    flat = TR.fit_trees(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y", P, rows=["id"])
    assert all(t["feature"] == [-1] for t in flat["trees"])
    assert np.array_equal(TR.to_bins(np.array([[np.nan], [1.0], [2.0], [3.0]]), [[1.0, 2.0]])[:, 0], [0, 1, 2, 3])
