"""One-step forecasts per series.

Each forecaster is ``(df, value, keys, order) -> DataFrame(keys..., name, forecast)``.
Fits reduce to per-key sums (moments or Gram matrices) built by partial aggregation,
so a long or hot series never lands in one task; only p x p summaries are solved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round_half_even
from . import ordered as O
from .gram import gram, solve
from .panel import last_row


ONE = "__one"


def _keyed(df: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """An unkeyed series gets a constant key, so every join below is an equi-join."""
    keys = list(keys)
    if keys:
        return df, keys
    return df.withColumn(ONE, F.lit(0)), [ONE]


def _unkey(df: DataFrame) -> DataFrame:
    return df.drop(ONE)


def _attach(left: DataFrame, right: DataFrame, keys: list[str], keyed: bool) -> DataFrame:
    """Per-key summary next to the rows: an equi-join on the keys; for one series the
    summary is a single small row (coefficients, next regressors), read once and added
    as literals, so no join on a constant key (a nested-loop join) is planned."""
    if keyed:
        return left.join(right, keys, "inner")
    extra = [c for c in right.columns if c not in keys]
    r = right.select(*extra).first()
    if r is None:
        return left.limit(0).withColumns({c: F.lit(None).cast(right.schema[c].dataType) for c in extra})
    return left.withColumns({c: F.lit(r[c]).cast(right.schema[c].dataType) for c in extra})


def dot(coef: Column, feats: Column) -> Column:
    return F.aggregate(F.zip_with(coef, feats, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def return_moments(df: DataFrame, value: str, keys=(), order="date") -> DataFrame:
    """AGG-07: mean and sample std of log returns (and their count) per key."""
    r = O.log_return(df, value, "__lr", keys=keys, order=order)
    return r.groupBy(*keys).agg(F.avg("__lr").alias("mu"), F.stddev_samp("__lr").alias("sigma"),
                                F.count("__lr").alias("n"))


def gbm_forecast(df: DataFrame, value: str, keys=(), order="date", z: float | None = None,
                 seed: int | None = None, name: str = "GBM") -> DataFrame:
    """FOR-01: ``S * exp((mu - sigma^2/2) + sigma * Z)``, rounded to 2. ``z`` fixes the draw
    (tests use 0); otherwise one seeded standard normal per series."""
    df, keys = _keyed(df, keys)
    order_l = O._as_list(order)
    r = O.log_return(df.select(*keys, *order_l, value), value, "__lr", keys=keys, order=order)
    # moments and the last value in one aggregate: no join back to the rows
    m = r.groupBy(*keys).agg(F.avg("__lr").alias("mu"), F.stddev_samp("__lr").alias("sigma"),
                             F.max_by(F.col(value), F.struct(*[F.col(o) for o in order_l])).alias(value))
    draw = F.lit(float(z)) if z is not None else F.randn(seed)
    f = F.col(value) * F.exp((F.col("mu") - F.col("sigma") ** 2 / 2) + F.col("sigma") * draw)
    return _unkey(m.select(*keys, F.lit(name).alias("name"), round_half_even(f, 2).alias("forecast")))


def ar_forecast(df: DataFrame, value: str, keys=(), order="date", p: int = 5,
                name: str = "ARIMA") -> DataFrame:
    """FOR-02: ARIMA(p,1,0) without constant, conditional least squares on the first
    difference: regress d_t on d_{t-1..t-p}, forecast ``last + sum(phi_i d_{T+1-i})``."""
    keyed = bool(list(keys))
    df, keys = _keyed(df, keys)
    d = O.difference(df.select(*keys, *O._as_list(order), value), value, "__d", keys, order)
    lagged = O.lag_matrix(d, "__d", p, keys, order, prefix="__dl")
    feats = [f"__dl{i}" for i in range(1, p + 1)]
    g = gram(lagged, feats, "__d", keys, intercept=False)
    coef = solve(g, keys, p).select(*keys, "coef")
    last = last_row(lagged, order, keys)
    nxt = F.array(F.col("__d"), *[F.col(f"__dl{i}") for i in range(1, p)])
    j = _attach(last, coef, keys, keyed)
    return _unkey(j.select(*keys, F.lit(name).alias("name"),
                           round_half_even(F.col(value) + dot(F.col("coef"), nxt), 2).alias("forecast")))


def _seasonal_features(t_days: Column, t_unit: Column, n_changepoints: int, weekly: int, yearly: int
                       ) -> list[Column]:
    feats = [t_unit]
    for j in range(1, n_changepoints + 1):
        s = 0.8 * j / (n_changepoints + 1)
        feats.append(F.greatest(t_unit - F.lit(s), F.lit(0.0)))
    for period, k_max in ((7.0, weekly), (365.25, yearly)):
        for k in range(1, k_max + 1):
            ang = F.lit(2 * np.pi * k / period) * t_days
            feats += [F.sin(ang), F.cos(ang)]
    return feats


def _seasonal_numpy(day: float, unit: float, n_changepoints: int, weekly: int, yearly: int) -> np.ndarray:
    """The same features as ``_seasonal_features`` for one point, with a leading 1."""
    f = [1.0, unit]
    f += [max(unit - 0.8 * j / (n_changepoints + 1), 0.0) for j in range(1, n_changepoints + 1)]
    for period, k_max in ((7.0, weekly), (365.25, yearly)):
        for k in range(1, k_max + 1):
            ang = 2 * np.pi * k / period * day
            f += [np.sin(ang), np.cos(ang)]
    return np.asarray(f)


def trend_seasonal_forecast(df: DataFrame, value: str, keys=(), order="date", n_changepoints: int = 25,
                            weekly: int = 3, yearly: int = 10, ridge: float = 1.0,
                            name: str = "trend_seasonal") -> DataFrame:
    """FOR-03: additive piecewise-linear trend (hinges at ``n_changepoints`` points in the
    first 80% of the time span) + weekly and yearly Fourier terms, fitted by ridge on
    the normal equations; forecast at the next calendar day. The Gram matrix is one
    distributed pass; solve and next-day features run per key in numpy."""
    keys = list(keys)
    keyed = bool(keys)
    order = O._as_list(order)[0]
    day = F.datediff(F.col(order).cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    span = df.groupBy(*keys).agg(F.min(day).alias("__t0"), F.max(day).alias("__t1"))
    if keys:
        base = df.select(*keys, order, value).withColumn("__day", day).join(span, keys, "inner")
    else:
        # one series: its time span is two scalars, read once
        r = span.first()
        df, keys = _keyed(df, keys)
        span = df.sparkSession.range(1).select(F.lit(0).alias(ONE), F.lit(r["__t0"]).alias("__t0"),
                                                 F.lit(r["__t1"]).alias("__t1"))
        base = df.select(*keys, order, value).withColumns(
            {"__day": day, "__t0": F.lit(r["__t0"]), "__t1": F.lit(r["__t1"])})
    unit = (F.col("__day") - F.col("__t0")) / F.greatest(F.col("__t1") - F.col("__t0"), F.lit(1.0))
    feats = _seasonal_features(F.col("__day"), unit, n_changepoints, weekly, yearly)
    names = [f"__x{i}" for i in range(len(feats))]
    x = base.select(*keys, value, *[f.alias(n) for f, n in zip(feats, names)])
    p = len(names) + 1
    g = _attach(gram(x, names, value, keys), span, keys, keyed)
    key_fields = [g.schema[c] for c in keys]
    schema = T.StructType(key_fields + [T.StructField("name", T.StringType()),
                                        T.StructField("forecast", T.DoubleType())])
    lam = ridge * np.ones(p)
    lam[0] = 0.0

    def fit(it):
        for pdf in it:
            out = []
            for d in pdf.to_dict("records"):
                a = np.asarray(d["xtx"], dtype=float).reshape(p, p) + np.diag(lam)
                coef = np.linalg.lstsq(a, np.asarray(d["xty"], dtype=float), rcond=None)[0]
                t0, t1 = float(d["__t0"]), float(d["__t1"])
                nxt = t1 + 1
                z = _seasonal_numpy(nxt, (nxt - t0) / max(t1 - t0, 1.0), n_changepoints, weekly, yearly)
                out.append([d[c] for c in keys] + [name, float(np.rint(float(z @ coef) * 100) / 100)])
            yield pd.DataFrame(out, columns=keys + ["name", "forecast"])

    return _unkey(g.mapInPandas(fit, schema))


def var_forecast(df: DataFrame, value: str, keys=(), order="date", max_lags: int = 15,
                 name: str = "VAR") -> DataFrame:
    """FOR-04: VAR on (value, weekday) with intercept; the lag order 1..max_lags with the
    lowest AIC = ln det(Sigma) + 2 k (k p + 1) / T on the common sample (t > max_lags);
    one-step forecast of the first component. One Gram matrix per key covers every
    order: each order is a sub-block of it."""
    keyed = bool(list(keys))
    df, keys = _keyed(df, keys)
    order_l = O._as_list(order)
    base = df.select(*keys, *order_l, value).withColumn(
        "__dow", F.weekday(F.col(order_l[0]).cast("date")).cast("double"))
    specs = {}
    for i in range(1, max_lags + 1):
        specs[f"__v{i}"] = (value, i)
        specs[f"__w{i}"] = ("__dow", i)
    lagged = O.shift(base, specs, keys, order)
    lag_names = [c for i in range(1, max_lags + 1) for c in (f"__v{i}", f"__w{i}")]
    # regressors: lags then the two current values, so the Gram holds X'X, X'Y and Y'Y
    g = gram(lagged, lag_names + [value, "__dow"], None, keys, intercept=True)
    last = last_row(lagged, order, keys)
    # next-step regressors: current values and the first max_lags - 1 lags
    nxt = F.array(*[c for i in range(max_lags) for c in (
        (F.col(value), F.col("__dow")) if i == 0 else (F.col(f"__v{i}"), F.col(f"__w{i}")))])
    j = _attach(g, last.select(*keys, nxt.alias("__next")), keys, keyed)
    k = 2
    q = 1 + k * max_lags + k
    key_fields = [j.schema[c] for c in keys]
    schema = T.StructType(key_fields + [T.StructField("name", T.StringType()),
                                        T.StructField("forecast", T.DoubleType()),
                                        T.StructField("lag_order", T.IntegerType())])

    def fit(it):
        for pdf in it:
            out = []
            for d in pdf.to_dict("records"):
                G = np.asarray(d["xtx"], dtype=float).reshape(q, q)
                n = float(d["n"])
                ycols = [q - 2, q - 1]
                best = None
                for p in range(1, max_lags + 1):
                    xcols = list(range(0, 1 + k * p))
                    XX = G[np.ix_(xcols, xcols)]
                    XY = G[np.ix_(xcols, ycols)]
                    YY = G[np.ix_(ycols, ycols)]
                    try:
                        B = np.linalg.solve(XX, XY)
                    except np.linalg.LinAlgError:
                        B = np.linalg.lstsq(XX, XY, rcond=None)[0]
                    S = (YY - XY.T @ B - B.T @ XY + B.T @ XX @ B) / n
                    det = np.linalg.det(S)
                    if not det > 0:  # nothing is left of a component but rounding, or the regressors are dependent
                        size, scale = np.sqrt(np.diag(XX)), np.sqrt(np.diag(YY) / n)
                        if not (size > 0).all() or not (scale > 0).all() or np.linalg.matrix_rank(XX / np.outer(size, size)) < len(XX):
                            continue
                        rest = np.linalg.eigvalsh(S / np.outer(scale, scale))
                        det = np.prod(np.maximum(rest, np.finfo(float).eps)) * np.prod(scale) ** 2
                    aic = np.log(det) + 2.0 * k * (k * p + 1) / n
                    if best is None or aic < best[0]:
                        best = (aic, p, B)
                if best is None:
                    continue
                _, p, B = best
                z = np.concatenate([[1.0], np.asarray(d["__next"], dtype=float)[:k * p]])
                f = float(z @ B[:, 0])
                out.append([d[c] for c in keys] + [name, float(np.round(f, 2)), int(p)])
            yield pd.DataFrame(out, columns=keys + ["name", "forecast", "lag_order"])

    return _unkey(j.mapInPandas(fit, schema))


def last_value(df: DataFrame, value: str, keys=(), order="date", name: str = "last_value") -> DataFrame:
    keys = list(keys)
    last = last_row(df.select(*list(keys), *O._as_list(order), value), order, keys)
    return last.select(*keys, F.lit(name).alias("name"), F.col(value).cast("double").alias("forecast"))


def ensemble_mean(forecasts: DataFrame, keys=(), exclude=("last_value",), name="average_expected"
                  ) -> DataFrame:
    """AGG-08: mean of all forecasts except ``last_value``, rounded to 2."""
    f = forecasts.filter(~F.col("name").isin(list(exclude)))
    return f.groupBy(*keys).agg(round_half_even(F.avg("forecast"), 2).alias("forecast")).select(
        *keys, F.lit(name).alias("name"), "forecast")


def forecast_all(df: DataFrame, value: str, keys=(), order="date", z: float | None = 0.0,
                 model: DataFrame | None = None) -> DataFrame:
    """FOR-05: the four forecasts, an optional model prediction, ``last_value`` and the
    average (over everything but ``last_value``), as one ``(keys, name, forecast)`` table."""
    keys = list(keys)
    df = df.select(*keys, *O._as_list(order), value).checkpoint(eager=True)  # four fits read the series several times
    parts = [ar_forecast(df, value, keys, order), gbm_forecast(df, value, keys, order, z=z),
             trend_seasonal_forecast(df, value, keys, order), var_forecast(df, value, keys, order).drop("lag_order")]
    if model is not None:
        parts.append(model.select(*keys, "name", "forecast"))
    f = parts[0]
    for p in parts[1:]:
        f = f.unionByName(p)
    f = f.unionByName(last_value(df, value, keys, order)).checkpoint(eager=True)  # a few rows a key; the mean reads them again
    return f.unionByName(ensemble_mean(f, keys))
