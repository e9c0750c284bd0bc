"""NUM checks: fits against numpy closed forms on small fixtures."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import models as M
from tessera.operators import project as PJ
from tessera.operators.gram import gram


def _regression(spark, n=300, p=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    y = x @ np.arange(1, p + 1) + 3 + rng.normal(scale=0.5, size=n)
    rows = [tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)]
    cols = [f"x{i}" for i in range(p)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", y double"), x, y, cols


def test_ridge_and_lasso(spark):
    df, x, y, cols = _regression(spark)
    st = M.GramStats(gram(df, cols, "y").first(), len(cols))
    w, b = M.ridge_closed(st, 0.1)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 0.1 * np.eye(len(cols)), xc.T @ yc)
    assert np.allclose(w, want) and abs(b - (y.mean() - x.mean(0) @ want)) < 1e-9
    wl, bl = M.lasso_cd(st, 0.1, 5000, 1e-10)
    # KKT conditions of (1/2n)|yc - Xc w|^2 + a|w|_1
    g = xc.T @ (yc - xc @ wl) / len(y)
    nz = np.abs(wl) > 1e-9
    assert np.allclose(g[nz], 0.1 * np.sign(wl[nz]), atol=1e-6)
    assert np.all(np.abs(g[~nz]) <= 0.1 + 1e-6)


def test_yeo_johnson_lambda(spark):
    rng = np.random.default_rng(3)
    x = rng.lognormal(size=2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = FE.fit_yeo_johnson(df, ["x"])["x"]

    def ll(l):
        y = ((x + 1) ** l - 1) / l if abs(l) > 1e-12 else np.log1p(x)
        return -len(x) / 2 * np.log(y.var()) + (l - 1) * np.sum(np.log1p(x))
    grid = np.linspace(-3, 3, 60001)
    best = grid[np.argmax([ll(l) for l in grid])]
    assert abs(lam - best) < 2e-3


def test_lda_matches_numpy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(3):
        for v in rng.normal(loc=c, size=(50, 4)):
            rows.append((len(rows), [float(t) for t in v], c))
    df = spark.createDataFrame(rows, "id long, emb array<double>, label int")
    out = PJ.lda_projection(df, "emb", 4, "label", ["id"]).orderBy("id").toPandas()
    X = np.array([r[1] for r in rows]); y = np.array([r[2] for r in rows])
    mu = X.mean(0)
    sw = sum((X[y == c] - X[y == c].mean(0)).T @ (X[y == c] - X[y == c].mean(0)) for c in range(3)) / (len(X) - 3)
    sb = sum((y == c).sum() * np.outer(X[y == c].mean(0) - mu, X[y == c].mean(0) - mu) for c in range(3))
    vals, vecs = np.linalg.eig(np.linalg.solve(sw, sb))
    v = np.real(vecs[:, np.argmax(np.real(vals))])
    v /= np.sqrt(v @ sw @ v)
    z = (X - mu) @ v
    assert np.allclose(np.abs(out["LDA1"].to_numpy()), np.abs(z), atol=1e-6)


def test_kernel_pca_exact_when_all_landmarks(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(40, 3))
    df = spark.createDataFrame([(i, [float(t) for t in r]) for i, r in enumerate(X)], "id long, emb array<double>")
    out = PJ.kernel_pca(df, "emb", 3, "id", ["id"], n_components=2, n_landmarks=40).orderBy("id").toPandas()
    K = np.exp(-((X[:, None] - X[None]) ** 2).sum(-1) / 3)
    n = len(X); one = np.ones((n, n)) / n
    Kc = K - one @ K - K @ one + one @ K @ one
    vals, vecs = np.linalg.eigh(Kc)
    idx = np.argsort(vals)[::-1][:2]
    want = vecs[:, idx] * np.sqrt(vals[idx])
    for j in range(2):
        assert np.allclose(np.abs(out[f"KPC{j + 1}"].to_numpy()), np.abs(want[:, j]), atol=1e-5)


def test_knn_imputer_rule(spark):
    rows = [(1, 1.0, 2.0, None), (2, 1.1, 2.1, 3.0), (3, 5.0, 5.0, 9.0), (4, 1.2, None, 4.0), (5, 0.9, 1.9, 5.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out = {r["id"]: r for r in FE.impute_knn(df, "id", ["a", "b", "c"], k=2).collect()}
    assert abs(out[1]["c"] - 4.0) < 1e-12          # donors 2 and 5 are nearest
    assert out[4]["b"] is not None


def test_exact_quantiles_multi_round(spark):
    from tessera.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=20000), np.full(5000, 0.25), rng.integers(0, 9, 3000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0], small=200)  # forces narrowing rounds
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert abs(got[("x", p)] - np.quantile(x, p)) < 1e-12
