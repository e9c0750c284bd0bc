"""Fitted preparation against numpy, saved and read again in a new session; unknown names are errors."""

import json
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import knn as KN
from tessera.operators import project as PJ
from tessera.operators import stages as ST

COLS = ["a", "b", "c", "d"]


def table(spark, n=240, seed=4, gaps=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) @ np.array([[1, .8, 0, 0], [0, 1, .5, 0], [0, 0, 1, .3], [0, 0, 0, 1]]) + [1, 2, 3, 4]
    x = np.where(rng.random((n, 4)) < gaps, np.nan, np.round(x, 3))
    y = np.nan_to_num(x) @ [1, -2, 3, .5] + rng.normal(scale=.1, size=n)
    rows = [(i, *(None if v != v else float(v) for v in r), float(t), "train" if i < n * 0.7 else "test") for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double, split string").repartition(3), x, y


def brute_knn(x, k):
    out, m = x.copy(), x.shape[1]
    means = np.nanmean(x, axis=0)
    for i, j in zip(*np.where(np.isnan(x))):
        best = []
        for o in range(len(x)):
            on = ~np.isnan(x[i]) & ~np.isnan(x[o])
            if o != i and on.any() and not np.isnan(x[o, j]):
                best.append((np.sqrt(m / on.sum() * ((x[i, on] - x[o, on]) ** 2).sum()), o))
        best = sorted(best)[:k]
        out[i, j] = np.mean([x[o, j] for _, o in best]) if best else means[j]
    return out


@pytest.mark.parametrize("n, gaps, pivots", [(150, 0.15, None), (120, 0.5, 7), (60, 0.3, 1)])
def test_knn_equals_all_pairs(spark, n, gaps, pivots):
    df, x, _ = table(spark, n, gaps=gaps)
    got = KN.impute_knn(df, "id", COLS, 5, pivots=pivots).orderBy("id").toPandas()[COLS].to_numpy()
    assert np.allclose(got, brute_knn(x, 5))


def test_knn_copies_keys_and_empty_rows(spark):
    """Many equal donors count by their ids, keys do not mix, a row without any value and a column without donors get means."""
    x = np.array([[0., 1.]] * 30 + [[0., np.nan]] * 10 + [[5., 9.]] * 3 + [[np.nan, np.nan], [4.9, np.nan]])
    rows = [(i, None if a != a else float(a), None if b != b else float(b), k) for k in ("u", None) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, k string")
    got = KN.impute_knn(df, "id", ["a", "b"], 4, keys=["k"]).orderBy("k", "id").toPandas()
    want = brute_knn(x, 4)
    assert np.allclose(got[["a", "b"]].to_numpy(), np.vstack([want, want]))


def test_knn_does_not_compare_all_pairs(spark):
    """Ten times the donors are compared with less than half of ten times the pairs a receiver."""
    def pairs(n):
        rng = np.random.default_rng(1)
        donors = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(rng.random((n, 3)))], "id long, a double, b double, c double")
        asked = spark.createDataFrame([(f"r{i}", [float(a), float(b), None]) for i, (a, b) in enumerate(rng.random((50, 2)))], "vid string, _x array<double>")
        found = KN.distinct_donors(donors, "id", ["a", "b", "c"], 5).checkpoint()
        marks = KN.pick_pivots(found, 3)
        placed = KN._to_cells(found, spark.createDataFrame([("", ["001"])], "_g string, rs array<string>"), marks, 3).checkpoint()
        visits = KN._visits(asked.withColumns({"_g": F.lit(""), "_r": F.lit("001")}), KN.cell_stats(placed, 5), marks, 5, 3)
        return visits.join(placed, ["_g", "_r", "_gaps", "cell"]).count()

    assert pairs(5000) < 5 * pairs(500) and pairs(5000) < 0.1 * 50 * 5000


def test_iterative_equals_a_plain_loop(spark):
    df, x, _ = table(spark, 200, gaps=0.2)
    got = FE.impute_iterative(df, COLS, tol=1e-9, max_iter=200).orderBy("id").toPandas()[COLS].to_numpy()
    shift, scale = np.nanmean(x, axis=0), np.nanstd(x, axis=0)
    z = (x - shift) / scale
    mu, sigma = np.zeros(4), np.eye(4)
    for _ in range(200):
        first, second = np.zeros(4), np.zeros((4, 4))
        filled = z.copy()
        for i, r in enumerate(z):
            m = np.isnan(r)
            o = ~m
            extra = np.zeros((4, 4))
            if m.any():
                k = sigma[np.ix_(m, o)] @ np.linalg.pinv(sigma[np.ix_(o, o)])
                filled[i, m] = mu[m] + k @ (r[o] - mu[o])
                extra[np.ix_(m, m)] = sigma[np.ix_(m, m)] - k @ sigma[np.ix_(o, m)]
            first += filled[i]
            second += np.outer(filled[i], filled[i]) + extra
        mu, sigma = first / len(z), second / len(z) - np.outer(first, first) / len(z) ** 2
    assert np.allclose(got, filled * scale + shift, atol=1e-6)


def test_kernel_pca_within_its_tolerance(spark):
    """500 rows: what the landmarks lose of the kernel is within the tolerance, and the components are near the exact ones."""
    rng = np.random.default_rng(8)
    X = rng.normal(size=(500, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(X)], "id long, a double, b double, c double").repartition(5)
    fit = PJ.fit_kernel_pca(df, ["a", "b", "c"], "id", 3, tol=1e-3)
    K = np.exp(-((X[:, None] - X[None]) ** 2).sum(-1) / 3)
    phi = PJ.rbf(X, fit.landmarks, fit.gamma) @ fit.proj
    assert fit.residual <= 1e-3 and abs(np.mean(1 - (phi ** 2).sum(1)) - fit.residual) < 1e-6 and len(fit.landmarks) < 250
    H = np.eye(500) - 1 / 500
    vals = np.sort(np.linalg.eigvalsh(H @ K @ H))[::-1][:3]
    z = (phi - fit.mean) @ fit.w
    assert np.all(vals - (z ** 2).sum(0) >= -1e-6) and np.all(vals - (z ** 2).sum(0) <= 500 * 1e-3)


def stages():
    return [ST.imputer("iterative", inputCols=COLS), ST.outlier_handler("yeo", inputCols=COLS, options='{"k": 1.0}'),
            ST.scaler("robust", inputCols=COLS, splitCol="split"), ST.regressor("ridge", {"alpha": 0.1}, COLS, "label", splitCol="split")]


def test_a_saved_pipeline_predicts_the_same_in_a_new_session(spark, tmp_path):
    df, _, _ = table(spark)
    model = Pipeline(stages=stages()).fit(df)
    path, rows = str(tmp_path / "model"), str(tmp_path / "rows")
    model.write().overwrite().save(path)
    df.write.parquet(rows)
    script = textwrap.dedent(f"""
        import json
        from pyspark.ml import PipelineModel
        from tessera.session import build_session
        spark = build_session(master="local[2]", shuffle_partitions=2)
        got = PipelineModel.load({path!r}).transform(spark.read.parquet({rows!r})).orderBy("id").select("prediction").collect()
        print(json.dumps([r[0] for r in got]))""")
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    want = [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()]
    assert np.allclose(json.loads(out.stdout.strip().splitlines()[-1]), want, rtol=0, atol=1e-12), out.stderr[-500:]


def test_learned_on_train_only(spark):
    df, x, _ = table(spark, gaps=0)
    for name, center, spread in (("standard", np.mean, np.std), ("robust", np.median, lambda v: np.subtract(*np.percentile(v, [75, 25])))):
        got = json.loads(ST.scaler(name, inputCols=COLS, splitCol="split").fit(df).getOrDefault("state"))
        train = x[:168]
        assert np.allclose([got[c] for c in COLS], [(center(train[:, j]), spread(train[:, j])) for j in range(4)])


@pytest.mark.parametrize("kind", ["knn", "selectkbest", "variancethreshold", "lda", "kernelpca", "xgboost", "lasso", "median", "log"])
def test_every_stage_reads_back(spark, tmp_path, kind):
    df, _, _ = table(spark, 120, gaps=0.1 if kind in ("knn", "median") else 0)
    how = {"knn": lambda: ST.imputer("knn", inputCols=COLS, options='{"row_id": "id", "k": 3}'), "median": lambda: ST.imputer("median", inputCols=COLS),
           "log": lambda: ST.outlier_handler("log", inputCols=COLS, options='{"k": 0.5}'),
           "selectkbest": lambda: ST.feature_processor("selectkbest", inputCols=COLS, options='{"k": 2, "target": "label"}'),
           "variancethreshold": lambda: ST.feature_processor("variancethreshold", inputCols=COLS, options='{"threshold": 1.2}'),
           "lda": lambda: ST.feature_processor("lda", inputCols=COLS, options='{"target": "split"}'),
           "kernelpca": lambda: ST.feature_processor("kernelpca", inputCols=COLS, options='{"row_id": "id", "n_components": 2}'),
           "xgboost": lambda: ST.regressor("xgboost", {"n_estimators": 5, "max_depth": 2}, COLS, "label"),
           "lasso": lambda: ST.regressor("lasso", {"alpha": 0.01}, COLS, "label")}[kind]()
    model = Pipeline(stages=[how]).fit(df)
    model.write().overwrite().save(str(tmp_path / kind))
    a, b = (m.transform(df).orderBy("id").toPandas() for m in (model, PipelineModel.load(str(tmp_path / kind))))
    assert list(a) == list(b) and a.equals(b)
    if kind == "selectkbest":
        assert sum(c in a for c in COLS) == 2
    if kind in ("knn", "median"):
        assert not a[COLS].isna().any().any()


def test_unknown_names_are_errors():
    for choose in (ST.imputer, ST.outlier_handler, ST.scaler, ST.feature_processor):
        with pytest.raises(ValueError, match="unknown"):
            choose("other")
    with pytest.raises(ValueError, match="unknown model"):
        ST.regressor("lstm", {}, COLS, "label")
