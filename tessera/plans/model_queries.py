"""Models, grid search, scoring, run records and forecasts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import models as M
from ..operators import stages as ST
from ..operators.panel import argmax_params, last_row
from ..session import table_path
from .fixtures import SERIES, SQL_DAILY_ORDERS, daily_orders
from .panel_queries import panel_features
from .quality_queries import _sql_metrics, naive_metrics
from .registry import ORACLE, query, round_doubles

FEATURES = SERIES + [f"{c}_pct_chg" for c in SERIES]
LABEL = "target"
LASSO = {"alpha": 0.1, "max_iter": 1000}
RIDGE = {"alpha": 0.1, "solver": "auto"}
TREES = {"n_estimators": 200, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0,
         "gamma": 0}


def model_data(spark, sf):
    """F7 shape: the panel's values and returns, next-hour target, time split; rows
    with a gap dropped (the last row has no target)."""
    # fits read it many times (trees: once per iteration); materialise it once
    return panel_features(spark, sf).na.drop(subset=FEATURES + [LABEL]).checkpoint(eager=True)


def _coef_table(spark, coef, b):
    rows = [("intercept", float(b))] + [(f, float(w)) for f, w in zip(FEATURES, coef)]
    return spark.createDataFrame(rows, "feature string, coef double")


@query("lasso")
def q_lasso(spark, sf):
    st = M.split_grams(model_data(spark, sf), FEATURES, LABEL)["train"]
    return round_doubles(_coef_table(spark, *M.lasso_cd(st, LASSO["alpha"], LASSO["max_iter"])))


def sql_linear(table, columns, label, ridge, where="true", name="w", centred=True):
    """CTEs that solve the centred normal equations of ``label`` on ``columns`` by elimination, with ``ridge`` on the diagonal;
    the last one, ``name``, has w0.. and the intercept (0 if not ``centred``)."""
    n = len(columns)
    own = f"{name}_rows AS (SELECT {', '.join(columns)}, {label} AS y FROM {table} WHERE {where})"
    mean_of = (lambda c: f"avg({c})") if centred else (lambda c: "0.0")
    mean = f"{name}_mean AS (SELECT {', '.join(f'{mean_of(c)} AS m{i}' for i, c in enumerate(columns))}, {mean_of('y')} AS my{f' FROM {name}_rows' if centred else ''})"
    cells = [f"sum(({a} - m{i}) * ({b} - m{j})){f' + {ridge}' if i == j else ''} AS a{i}_{j}"
             for i, a in enumerate(columns) for j, b in enumerate(columns)]
    cells += [f"sum(({a} - m{i}) * (y - my)) AS a{i}_{n}" for i, a in enumerate(columns)]
    ctes = [own, mean, f"{name}_0 AS (SELECT {', '.join(cells)} FROM {name}_rows, {name}_mean)"]
    for k in range(n):
        cells = [f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" if i != k else f"a{k}_{j} / a{k}_{k} AS a{k}_{j}"
                 for i in range(n) for j in range(k + 1, n + 1)]
        ctes.append(f"{name}_{k + 1} AS (SELECT {', '.join(cells)} FROM {name}_{k})")
    weights = [f"a{i}_{n} AS w{i}" for i in range(n)]
    intercept = "my" + "".join(f" - a{i}_{n} * m{i}" for i in range(n))
    return ",\n".join([*ctes, f"{name} AS (SELECT {', '.join(weights)}, {intercept} AS intercept FROM {name}_{n}, {name}_mean)"])


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*FEATURES, LABEL])


@query("ridge", f"""WITH p AS ({ORACLE["panel_features"]}),
{sql_linear("p", FEATURES, LABEL, RIDGE["alpha"], f"split = 'train' AND {_COMPLETE}")}
{" UNION ALL ".join(f"SELECT '{n}' AS feature, round({x}, 6) AS coef FROM w" for n, x in
                    [("intercept", "intercept"), *((c, f"w{i}") for i, c in enumerate(FEATURES))])}""")
def q_ridge(spark, sf):
    st = M.split_grams(model_data(spark, sf), FEATURES, LABEL)["train"]
    return round_doubles(_coef_table(spark, *M.ridge_closed(st, RIDGE["alpha"])))


@query("boosted_trees")
def q_boosted_trees(spark, sf):
    return round_doubles(M.refit_and_score(model_data(spark, sf), FEATURES, LABEL, "xgboost", TREES))


def searched(spark, sf):
    return M.grid_search(model_data(spark, sf), FEATURES, LABEL, rows=["hour"])


@query("param_grid")
def q_param_grid(spark, sf):
    """All 264 sets, each with the score of its fit."""
    return round_doubles(M.param_grid_table(spark).join(searched(spark, sf).drop("params"), ["model", "idx"], "left"))


@query("grid_search")
def q_grid_search(spark, sf):
    return round_doubles(M.best_params(searched(spark, sf)))


@query("refit_and_score")
def q_refit_and_score(spark, sf):
    """The set with the best score of all models, refitted."""
    d = model_data(spark, sf)
    best = M.best_params(M.grid_search(d, FEATURES, LABEL, rows=["hour"])).orderBy(F.desc("val_r2"), "model").first()
    return round_doubles(M.refit_and_score(d, FEATURES, LABEL, best["model"], json.loads(best["params"])))


@query("model_report")
def q_model_report(spark, sf):
    return M.tune(model_data(spark, sf), FEATURES, LABEL, rows=["hour"])


@query("track_run")
def q_track_run(spark, sf):
    """Two runs appended to one table, the first one recorded twice."""
    d, path = model_data(spark, sf), table_path(spark, f"runs-{uuid.uuid4().hex}")
    for run, model, params in (("run-lasso", "lasso", LASSO), ("run-ridge", "ridge", RIDGE), ("run-lasso", "lasso", LASSO)):
        record = M.track_run(M.refit_and_score(d, FEATURES, LABEL, model, params), run, "20250613_2209", params)
        runs = M.append_run(record, path)
    short = F.round(F.expr("try_cast(value AS double)"), 6).cast("string")
    return runs.withColumn("value", F.when(F.col("kind") == "metric", short).otherwise(F.col("value")))


def ranked_first(d):
    """MOD-09: name and parameters of the first model of the report (linear grids and a small one of trees)."""
    grids = M.REGRESSORS | {"xgboost": {k: v[:1] for k, v in M.REGRESSORS["xgboost"].items()}}
    first = M.tune(d, FEATURES, LABEL, ["hour"], grids=grids).filter("rank = 1").first()
    return first["model"], json.loads(first["params"])


@query("train_final_and_score")
def q_train_final_and_score(spark, sf):
    d = model_data(spark, sf)
    _, met = M.train_final(d, FEATURES, LABEL, *ranked_first(d))
    return round_doubles(met)


def saved_path(spark, name):
    return table_path(spark, f"models/{name}-{uuid.uuid4().hex}")


@query("save_load_model", f"""SELECT hour, true AS same FROM ({ORACLE["panel_features"]}) AS p
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*FEATURES, LABEL])}""")
def q_save_load_model(spark, sf):
    d = model_data(spark, sf)
    model, _ = M.train_final(d, FEATURES, LABEL, "ridge", RIDGE)
    back = M.load_model(M.save_model(model, saved_path(spark, "ridge")))
    a = model.transform(d).select("hour", F.col("prediction").alias("p1"))
    b = back.transform(d).select("hour", F.col("prediction").alias("p2"))
    return a.join(b, "hour").select("hour", (F.abs(F.col("p1") - F.col("p2")) < 1e-9).alias("same"))


@query("predict_last", f"""WITH p AS ({ORACLE["panel_features"]}),
tv AS (SELECT * FROM p WHERE split IN ('train', 'val') AND {_COMPLETE}),
s AS (SELECT {", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS d_{c}" for c in FEATURES)} FROM tv),
z AS (SELECT {", ".join(f"({c} - c_{c}) / d_{c} AS {c}" for c in FEATURES)}, {LABEL} FROM tv, s),
{sql_linear("z", FEATURES, LABEL, RIDGE["alpha"])},
t AS (SELECT * FROM p ORDER BY hour DESC LIMIT 1)
SELECT hour, {", ".join(f"round(t.{c}, 6) AS {c}" for c in SERIES)},
  round(intercept + {" + ".join(f"w{i} * (coalesce(t.{c}, c_{c}) - c_{c}) / d_{c}" for i, c in enumerate(FEATURES))}, 6) AS prediction
FROM t, s, w""")
def q_predict_last(spark, sf):
    """The newest row as the saved pipeline (means, scaler, ridge) scores it after it has been read back."""
    d = model_data(spark, sf)
    prepare = [ST.imputer("mean", inputCols=FEATURES), ST.scaler("standard", inputCols=FEATURES)]
    model, _ = M.train_final(d, FEATURES, LABEL, "ridge", RIDGE, prepare=prepare)
    back = M.load_model(M.save_model(model, saved_path(spark, "last")))
    last = last_row(panel_features(spark, sf), "hour")
    raw = last.select("hour", *SERIES)
    return round_doubles(raw.join(back.transform(last).select("hour", "prediction"), "hour"))


@query("argmax_params", f"""SELECT series, arg_max(idx, r2 * 1e6 - idx) AS idx, round(max(r2), 6) AS r2 FROM (
  SELECT *, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS idx FROM {_sql_metrics()}) GROUP BY series""")
def q_argmax_params(spark, sf):
    m = naive_metrics(spark, sf).withColumn(
        "idx", F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2))
    best = argmax_params(m, "r2", "idx", ["series"], ["idx", "r2"])
    return round_doubles(best.withColumn("idx", F.col("idx").cast("int")))


@query("rank_models", f"""SELECT series, round(adjusted_r2, 6) AS test_adj_r2,
  row_number() OVER (ORDER BY CASE WHEN adjusted_r2 = 0 THEN NULL ELSE adjusted_r2 END DESC NULLS LAST, series) AS rank
FROM {_sql_metrics()} WHERE split = 'test'""")
def q_rank_models(spark, sf):
    m = naive_metrics(spark, sf).filter(F.col("split") == "test").select(
        "series", F.col("adjusted_r2").alias("test_adj_r2"))
    return round_doubles(M.ranked(m, "test_adj_r2", "series"))


# ---------------------------------------------------------------- forecasts

_AR = [f"d{i}" for i in range(1, 6)]


@query("ar_forecast", f"""WITH {SQL_DAILY_ORDERS},
diff AS (SELECT date, value, value - lag(value) OVER (ORDER BY date) AS d0 FROM daily),
l AS (SELECT *, {", ".join(f"lag(d0, {i}) OVER (ORDER BY date) AS d{i}" for i in range(1, 6))} FROM diff),
{sql_linear("l", _AR, "d0", 0.0, " AND ".join(f"{c} IS NOT NULL" for c in _AR), centred=False)},
t AS (SELECT * FROM l ORDER BY date DESC LIMIT 1)
SELECT 'ARIMA' AS name, round_even(value + {" + ".join(f"w{i} * d{i}" for i in range(5))}, 2) AS forecast FROM t, w""")
def q_ar_forecast(spark, sf):
    return FC.ar_forecast(daily_orders(spark, sf), "value", order="date")


@query("trend_seasonal_forecast")
def q_trend_seasonal_forecast(spark, sf):
    return FC.trend_seasonal_forecast(daily_orders(spark, sf), "value", order="date")


@query("var_forecast")
def q_var_forecast(spark, sf):
    return FC.var_forecast(daily_orders(spark, sf), "value", order="date")


@query("forecast_all")
def q_forecast_all(spark, sf):
    return FC.forecast_all(daily_orders(spark, sf), "value", order="date", z=0.0)
