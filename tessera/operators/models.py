"""Regression models, grid search, scoring and run records.

Linear models are fitted from per-split Gram matrices (one distributed pass per
split), so a whole parameter grid costs two passes over the data: Lasso by coordinate
descent on the centred Gram (sklearn objective ``1/(2n)|y - Xw - b|^2 + a|w|_1``),
Ridge in closed form (``|y - Xw - b|^2 + a|w|^2``). Boosted trees grow for all sets together
(``trees``). The final model is a PipelineModel of fitted stages (``stages``), so it can be saved and reloaded.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import trees as TR
from .gram import gram
from .metrics import regression_metrics

# The parameter grids of the reference's regressor configuration
# (keys in file order; the last key varies fastest).
REGRESSORS = {
    "lasso": {"alpha": [0.001, 0.1], "max_iter": [1000, 5000]},
    "ridge": {"alpha": [0.001, 0.1], "solver": ["auto", "lsqr"]},
    "xgboost": {"n_estimators": [100, 200], "max_depth": [3, 5], "learning_rate": [0.01, 0.1],
                "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0], "gamma": [0, 0.1],
                "reg_alpha": [0, 0.1], "reg_lambda": [1.0, 1.5]},
}
ALLOWED_MODELS = ("lasso", "ridge", "xgboost")


def param_grid(grid: dict[str, list]) -> list[dict]:
    """MOD-04: Cartesian product, keys in order, last key fastest."""
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def param_grid_table(spark: SparkSession, grids: dict[str, dict] = REGRESSORS) -> DataFrame:
    """MOD-04 as a table ``(model, idx, params)``: exploded value lists, index by
    mixed-radix arithmetic (no join, no window)."""
    out = None
    for model, grid in grids.items():
        keys = list(grid)
        d = spark.range(1).select(F.lit(model).alias("model"))
        idx = F.lit(0)
        for k in keys:
            vals = F.array(*[F.lit(json.dumps(v)) for v in grid[k]])
            d = d.select("*", F.posexplode(vals).alias(f"__i_{k}", f"__v_{k}"))
        for k in keys:
            idx = idx * len(grid[k]) + F.col(f"__i_{k}")
        params = F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(json.dumps(k) + ": "), F.col(f"__v_{k}"))
                                                          for k in keys]), F.lit("}"))
        d = d.select("model", idx.cast("long").alias("idx"), params.alias("params"))
        out = d if out is None else out.unionByName(d)
    return out


# ------------------------------------------------------------ linear algebra

class GramStats:
    """Centred normal equations of one split (from ``gram`` with an intercept column)."""

    def __init__(self, row, p: int):
        self.n = float(row["n"])
        a = np.asarray(row["xtx"], dtype=float).reshape(p + 1, p + 1)
        b = np.asarray(row["xty"], dtype=float)
        self.yty = float(row["yty"])
        self.xbar = a[0, 1:] / self.n
        self.ybar = b[0] / self.n
        self.xx = a[1:, 1:] - self.n * np.outer(self.xbar, self.xbar)
        self.xy = b[1:] - self.n * self.xbar * self.ybar
        self.raw_xx, self.raw_xy = a, b

    def sse(self, coef: np.ndarray, intercept: float) -> float:
        w = np.concatenate([[intercept], coef])
        return float(self.yty - 2 * w @ self.raw_xy + w @ self.raw_xx @ w)

    def sst(self) -> float:
        return float(self.yty - self.n * self.ybar ** 2)


def lasso_cd(st: GramStats, alpha: float, max_iter: int = 1000, tol: float = 1e-4) -> tuple[np.ndarray, float]:
    """MOD-01: coordinate descent on the centred Gram matrix."""
    p = len(st.xy)
    w = np.zeros(p)
    diag = np.diag(st.xx).copy()
    thr = alpha * st.n
    for _ in range(max_iter):
        biggest = 0.0
        for j in range(p):
            if diag[j] <= 0:
                continue
            rho = st.xy[j] - st.xx[j] @ w + diag[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - thr, 0.0) / diag[j]
            biggest = max(biggest, abs(new - w[j]))
            w[j] = new
        if biggest <= tol * max(np.max(np.abs(w)), 1e-12):
            break
    return w, float(st.ybar - st.xbar @ w)


def ridge_closed(st: GramStats, alpha: float) -> tuple[np.ndarray, float]:
    """MOD-02: ``(Xc'Xc + a I) w = Xc'yc``; intercept from the means."""
    p = len(st.xy)
    w = np.linalg.solve(st.xx + alpha * np.eye(p), st.xy)
    return w, float(st.ybar - st.xbar @ w)


def split_grams(df: DataFrame, features: Sequence[str], label: str, split: str = "split") -> dict[str, GramStats]:
    rows = gram(df, features, label, [split]).collect()  # one p x p summary per split
    return {r[split]: GramStats(r, len(features)) for r in rows}


#: parameters of the linear models; the solvers of a ridge differ in their way, not in their result
LINEAR = {"lasso": {"alpha", "max_iter"}, "ridge": {"alpha", "solver"}}
SOLVERS = ("auto", "lsqr", "cholesky", "svd")


def fit_linear(model: str, params: dict, st: GramStats) -> tuple[np.ndarray, float]:
    if unknown := set(params) - LINEAR.get(model, set(params)):
        raise ValueError(f"unknown {model} parameters: {sorted(unknown)}")
    if params.get("solver", "auto") not in SOLVERS:
        raise ValueError(f"unknown ridge solver {params['solver']!r}")
    if model == "lasso":
        return lasso_cd(st, float(params["alpha"]), int(params.get("max_iter", 1000)))
    if model == "ridge":
        return ridge_closed(st, float(params["alpha"]))
    raise ValueError(f"not a linear model: {model}")


def r2_from(st: GramStats, coef, intercept) -> float:
    sst = st.sst()
    return 1 - st.sse(coef, intercept) / sst if sst > 0 else float("nan")


# ------------------------------------------------------------ spark models

def build_estimator(model: str, params: dict, features: Sequence[str], label: str) -> Pipeline:
    """UDF-06: model name + params -> a pipeline of one fitted stage (an unknown model or parameter is an error)."""
    from .stages import regressor
    return Pipeline(stages=[regressor(model, params, features, label)])


def grid_search(df: DataFrame, features: Sequence[str], label: str, split: str = "split",
                models: Sequence[str] = ALLOWED_MODELS, grids: dict = REGRESSORS, allowed: Sequence[str] = ALLOWED_MODELS,
                rows: Sequence[str] | None = None, local_cells: int = TR.LOCAL_CELLS) -> DataFrame:
    """MOD-05: every parameter set of every allowed model fitted on train and scored (R2) on val: a table
    ``(model, idx, params, val_r2)``. Linear models: all sets from two Gram passes. Trees: all sets grow together
    (see ``trees``); ``rows`` tell rows apart where trees sample them."""
    out = None
    for m in (m for m in models if m in allowed):
        sets = param_grid(grids[m])
        if m == "xgboost":
            parts = [df.filter(F.col(split) == s) for s in ("train", "val")]
            scores = TR.search_trees(*parts, features, label, sets, rows, local_cells=local_cells)
        else:
            stats = split_grams(df, features, label, split)
            fits = [fit_linear(m, p, stats["train"]) for p in sets]
            scores = df.sparkSession.createDataFrame([(i, float(r2_from(stats["val"], *f))) for i, f in enumerate(fits)], "idx long, val_r2 double")
        names = df.sparkSession.createDataFrame([(m, i, json.dumps(p)) for i, p in enumerate(sets)], "model string, idx long, params string")
        own = names.join(scores, "idx", "left").select("model", "idx", "params", "val_r2")
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("none of the models is allowed")
    return out


def best_params(results: DataFrame) -> DataFrame:
    """AGG-13 on the grid: best ``val_r2`` per model, first set wins ties."""
    from .panel import argmax_params
    return argmax_params(results, "val_r2", "idx", ["model"], ["idx", "params", "val_r2"])


def predict_linear(df: DataFrame, features: Sequence[str], coef, intercept: float, name: str = "prediction"
                   ) -> DataFrame:
    pred = F.lit(float(intercept))
    for c, w in zip(features, coef):
        pred = pred + F.lit(float(w)) * F.col(f"`{c}`")
    return df.withColumn(name, pred)


def refit_and_score(df: DataFrame, features: Sequence[str], label: str, model: str, params: dict,
                    split: str = "split") -> DataFrame:
    """MOD-06: refit the chosen set on train + val, metrics for train, val and test."""
    fitted = build_estimator(model, params, features, label).fit(df.filter(F.col(split).isin("train", "val")))
    return regression_metrics(fitted.transform(df), label, "prediction", [split], len(features))


SCORES = [f"{s}_{k}" for s in ("train", "val", "test") for k in ("rmse", "mae", "r2", "adjusted_r2")]


def report_row(df: DataFrame, features: Sequence[str], label: str, model: str, params: str, split: str = "split") -> DataFrame:
    """One row: model, params (JSON) and the scores of its refit, four places each."""
    from ..functions.numeric import round_half_even
    met = refit_and_score(df, features, label, model, json.loads(params), split)
    cells = {f"{s}_{k}": F.max(F.when(F.col(split) == s, F.col(k))) for s in ("train", "val", "test") for k in ("rmse", "mae", "r2", "adjusted_r2")}
    return met.agg(*(round_half_even(v, 4).alias(n) for n, v in cells.items())).select(F.lit(model).alias("model"), F.lit(params).alias("params"), *SCORES)


def tune(df: DataFrame, features: Sequence[str], label: str, rows: Sequence[str] | None = None, models: Sequence[str] = ALLOWED_MODELS,
         grids: dict = REGRESSORS) -> DataFrame:
    """MOD-05 to MOD-07: the whole grid searched, each model's best set refitted and scored, ranked by test adjusted R2."""
    best = best_params(grid_search(df, features, label, models=models, grids=grids, rows=rows)).collect()  # a row a model
    out = None
    for b in sorted(best, key=lambda b: b["model"]):
        own = report_row(df, features, label, b["model"], b["params"])
        out = own if out is None else out.unionByName(own)
    return ranked(out, "test_adjusted_r2", "model")


def ranked(report: DataFrame, score: str, name: str) -> DataFrame:
    """SRT-02 with its place as a column: a row's rank is one more than the number of rows before it."""
    from .panel import rank_models
    s = F.when((F.col(score) == 0) | F.isnan(score), None).otherwise(F.col(score))
    d = report.withColumn("__s", s)
    o = d.select(F.col("__s").alias("__o"), F.col(name).alias("__n"))
    ahead = (F.col("__o").isNotNull() & F.col("__s").isNull()) | (F.col("__o") > F.col("__s")) | (
        F.col("__o").eqNullSafe(F.col("__s")) & (F.col("__n") < F.col(name)))
    places = d.join(F.broadcast(o), ahead, "left").groupBy(name).agg((F.count("__n") + 1).cast("int").alias("rank"))  # a row a model
    return rank_models(d.drop("__s").join(places, name), score, name)


def track_run(metrics: DataFrame, run_id: str, ts: str, params: dict, split: str = "split") -> DataFrame:
    """MOD-08: long run record ``(run_id, ts, kind, name, value)``: params and
    ``<split>_<metric>`` values."""
    spark = metrics.sparkSession
    p = spark.createDataFrame([(run_id, ts, "param", k, str(v)) for k, v in params.items()],
                              "run_id string, ts string, kind string, name string, value string")
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("string").alias("v"))
                             for m in ("rmse", "mae", "r2", "adjusted_r2")]))
    m = metrics.select(split, st.alias("s")).select(
        F.lit(run_id).alias("run_id"), F.lit(ts).alias("ts"), F.lit("metric").alias("kind"),
        F.concat_ws("_", F.col(split), F.col("s.m")).alias("name"), F.col("s.v").alias("value"))
    return p.unionByName(m)


def append_run(record: DataFrame, path: str) -> DataFrame:
    """MOD-08: the record appended to the run table at ``path``, partitioned by run; a run that is recorded again replaces its own
    rows alone, other runs stay as they are. Returns the whole table."""
    (record.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))
    spark = record.sparkSession
    return spark.read.schema(record.schema).parquet(path)


def save_model(model: PipelineModel, path: str) -> str:
    """SNK-06: overwrite the stored model."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_final(df: DataFrame, features: Sequence[str], label: str, model: str, params: dict, split: str = "split",
                prepare: Sequence = ()) -> tuple[PipelineModel, DataFrame]:
    """MOD-09: fit on train, score train / val; refit on train + val, score test rows that have a label;
    returns the final model (with the fitted ``prepare`` stages inside) and the metrics table."""
    from .stages import regressor

    def fitted(rows: DataFrame) -> PipelineModel:
        return Pipeline(stages=[*prepare, regressor(model, params, features, label)]).fit(rows)

    tv = df.filter(F.col(split).isin("train", "val"))
    first = fitted(df.filter(F.col(split) == "train"))
    m1 = regression_metrics(first.transform(tv), label, "prediction", [split], len(features))
    final = fitted(tv)
    m2 = regression_metrics(final.transform(df.filter((F.col(split) == "test") & F.col(label).isNotNull())),
                            label, "prediction", [split], len(features))
    return final, m1.unionByName(m2)


def predict_last(model: PipelineModel, df: DataFrame, order: Sequence[str] | str, keys: Sequence[str] = ()
                 ) -> DataFrame:
    """MOD-10: score the newest row (per key) with a stored model."""
    from .panel import last_row
    return model.transform(last_row(df, order, keys))
