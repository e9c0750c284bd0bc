"""Feature preparation: imputation, outliers, scaling, selection.

Column statistics are fitted in one aggregation pass over all columns and come back
to the driver as one small row (one value per column), like ``pyspark.ml`` estimators
do; the transform is then a plain column expression with those values as literals.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import numeric_columns
from .knn import impute_knn  # noqa: F401


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _cols(df: DataFrame, cols, exclude=()) -> list[str]:
    return list(cols) if cols is not None else numeric_columns(df, exclude)


# ------------------------------------------------------------------ imputers

def fit_impute(df: DataFrame, cols=None, strategy: str = "mean", exclude=()) -> dict[str, float]:
    """IMP-01 / IMP-02 fit: column mean or exact median (nulls skipped)."""
    cols = _cols(df, cols, exclude)
    if strategy == "mean":
        aggs = [F.avg(_q(c)).alias(c) for c in cols]
    elif strategy == "median":
        from .quantiles import exact_quantiles
        q = exact_quantiles(df, cols, [0.5])
        return {c: q[(c, 0.5)] for c in cols}
    else:
        raise ValueError(f"unknown imputation strategy {strategy!r}")
    return df.agg(*aggs).first().asDict()


def impute(df: DataFrame, cols=None, strategy: str = "mean", exclude=()) -> DataFrame:
    """IMP-01 (mean) / IMP-02 (median): nulls take the column statistic."""
    fill = fit_impute(df, cols, strategy, exclude)
    return df.withColumns({c: F.coalesce(_q(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in fill.items() if v is not None})


def conditional_means(x: np.ndarray, mu: np.ndarray, sigma: np.ndarray, moments: bool = False):
    """Rows of ``x`` with their gaps (nan) at the mean given what is present. With ``moments``, instead the sums of
    the filled rows and of their products, to which a gap adds its variance given what is present."""
    p = x.shape[1]
    gaps = np.isnan(x)
    kinds, which = np.unique(gaps, axis=0, return_inverse=True)
    out, products = x.copy(), np.zeros((p, p))
    for k, gap in enumerate(kinds):
        if not gap.any():
            continue
        rows, have = np.flatnonzero(which.ravel() == k), ~gap
        slope = sigma[np.ix_(gap, have)] @ np.linalg.pinv(sigma[np.ix_(have, have)], hermitian=True)
        out[np.ix_(rows, gap)] = mu[gap] + (x[np.ix_(rows, have)] - mu[have]) @ slope.T
        products[np.ix_(gap, gap)] += len(rows) * (sigma[np.ix_(gap, gap)] - slope @ sigma[np.ix_(have, gap)])
    return out if not moments else (out.sum(axis=0), products + out.T @ out)


def fit_iterative(df: DataFrame, cols: Sequence[str], max_iter: int = 50, tol: float = 1e-6) -> dict:
    """IMP-04 fit: the mean and covariance of a normal distribution of the columns by expectation maximisation. Each round
    fills every gap with its mean given the row's other values and learns the moments anew, in one job whatever
    the number of columns; a batch works by pattern of gaps. Ends when no moment (of columns brought to deviation 1) moves
    by more than ``tol``, or after ``max_iter`` rounds. Columns without a value stay out."""
    cols = list(cols)
    got = df.agg(F.count(F.lit(1)).alias("n"), *[x for i, c in enumerate(cols) for x in (
        F.avg(_q(c)).alias(f"m{i}"), F.stddev_pop(_q(c)).alias(f"s{i}"), F.count(_q(c)).alias(f"n{i}"))]).first()
    use = [i for i in range(len(cols)) if got[f"n{i}"]]
    own = [cols[i] for i in use]
    shift = np.array([got[f"m{i}"] for i in use], dtype=float)
    scale = np.array([got[f"s{i}"] or 1.0 for i in use], dtype=float)
    p, n = len(own), got["n"]
    mu, sigma = np.zeros(p), np.diag([1.0 if got[f"s{i}"] else 0.0 for i in use])
    rounds = 0
    if any(got[f"n{i}"] < n for i in use):
        from .gram import sum_vectors
        rows = df.select(*(_q(c).cast("double").alias(f"x{j}") for j, c in enumerate(own)))
        for rounds in range(1, max_iter + 1):
            def moments(pdf, mu=mu, sigma=sigma):
                x = (pdf.to_numpy(dtype=float, na_value=np.nan) - shift) / scale
                first, second = conditional_means(x, mu, sigma, moments=True)
                return np.concatenate([first, second.ravel()])

            sums = sum_vectors(rows, moments, p + p * p)
            new_mu = sums[:p] / n
            new_sigma = sums[p:].reshape(p, p) / n - np.outer(new_mu, new_mu)
            moved = max(np.abs(new_mu - mu).max(), np.abs(new_sigma - sigma).max())
            mu, sigma = new_mu, (new_sigma + new_sigma.T) / 2
            if moved <= tol:
                break
    return {"columns": own, "shift": shift.tolist(), "scale": scale.tolist(), "mu": mu.tolist(), "sigma": sigma.tolist(), "rounds": rounds}


def fill_iterative(df: DataFrame, fit: dict) -> DataFrame:
    """Gaps of the fitted columns at their mean given the row's other values."""
    cols = fit["columns"]
    if not cols:
        return df
    shift, scale, mu, sigma = (np.asarray(fit[k]) for k in ("shift", "scale", "mu", "sigma"))

    @F.pandas_udf("array<double>")
    def fill(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for parts in batches:
            x = np.column_stack([v.to_numpy(dtype=float, na_value=np.nan) for v in parts])
            yield pd.Series(list(conditional_means((x - shift) / scale, mu, sigma) * scale + shift))

    filled = df.withColumn("__filled", fill(*(_q(c).cast("double") for c in cols)))
    return filled.withColumns({c: F.coalesce(_q(c).cast("double"), F.col("__filled")[j]) for j, c in enumerate(cols)}).drop("__filled")


def impute_iterative(df: DataFrame, cols=None, max_iter: int = 50, tol: float = 1e-6) -> DataFrame:
    """IMP-04: each gap becomes its mean given the row's other values, under the distribution that ``fit_iterative`` learns."""
    rows = df.checkpoint(eager=True)  # one pass a round
    return fill_iterative(rows, fit_iterative(rows, _cols(df, cols), max_iter, tol))


# ------------------------------------------------------------------ outliers

def iqr_outlier_columns(df: DataFrame, cols=None, k: float = 1.5, exclude=()) -> DataFrame:
    """OUT-01: per column Q1, Q3, bounds and whether any value lies strictly outside
    ``[Q1 - k IQR, Q3 + k IQR]`` — one pass (quantiles, min and max together)."""
    from .quantiles import exact_quantiles
    cols = _cols(df, cols, exclude)
    q = exact_quantiles(df, cols, [0.25, 0.75])
    ext = df.agg(*[x for c in cols for x in (F.min(_q(c)).cast("double").alias(f"{c}__min"),
                                            F.max(_q(c)).cast("double").alias(f"{c}__max"))]).first()
    rows = [(c, q[(c, 0.25)], q[(c, 0.75)], ext[f"{c}__min"], ext[f"{c}__max"]) for c in cols]
    long = df.sparkSession.createDataFrame(rows, "column string, q1 double, q3 double, mn double, mx double")
    iqr = F.col("q3") - F.col("q1")
    long = long.withColumn("lower", F.col("q1") - k * iqr).withColumn("upper", F.col("q3") + k * iqr)
    return long.select("column", "q1", "q3", "lower", "upper",
                       F.coalesce((F.col("mn") < F.col("lower")) | (F.col("mx") > F.col("upper")), F.lit(False))
                       .alias("is_outlier"))


def log_transform(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """OUT-02: ``ln`` on the given columns, skipping any column with a value <= 0."""
    if not cols:
        return df
    mins = df.agg(*[F.min(_q(c)).alias(c) for c in cols]).first().asDict()
    ok = [c for c in cols if mins[c] is not None and mins[c] > 0]
    return df.withColumns({c: F.ln(_q(c)) for c in ok})


def yeo_johnson_expr(x: Column, lam) -> Column:
    """Yeo-Johnson transform; ``lam`` is a number or a column."""
    lam_c = lam if isinstance(lam, Column) else F.lit(float(lam))
    pos = F.when(F.abs(lam_c) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam_c) - 1) / lam_c)
    neg = F.when(F.abs(lam_c - 2) < 1e-12, -F.log1p(-x)).otherwise(
        -(F.pow(1 - x, 2 - lam_c) - 1) / (2 - lam_c))
    return F.when(x >= 0, pos).otherwise(neg)


def fit_yeo_johnson(df: DataFrame, cols: Sequence[str], lo: float = -3.0, hi: float = 3.0,
                    points: int = 13, passes: int = 5) -> dict[str, float]:
    """OUT-03 fit: lambda by maximum likelihood, ``-n/2 ln var_pop(y_lambda) +
    (lambda - 1) sum sign(x) ln(1 + |x|)``, searched on a grid refined around the best
    point each pass. A pass is one aggregation: every value meets its column's grid of
    candidate lambdas and ``var_pop`` is taken per (column, lambda), reduced map-side."""
    cols = list(cols)
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), _q(c).cast("double").alias("x")) for c in cols]))
    # several passes read the same values: materialise the long form once (reliable
    # checkpoint in spark.checkpoint.dir) instead of recomputing the lineage per pass
    long = df.select(st.alias("s")).select("s.c", "s.x").filter(F.col("x").isNotNull()).checkpoint(eager=True)
    base = long.groupBy("c").agg(F.sum(F.signum("x") * F.log1p(F.abs("x"))).alias("s"),
                                 F.count(F.lit(1)).alias("n")).collect()
    s_of = {r["c"]: (r["s"], r["n"]) for r in base}
    grids = {c: np.linspace(lo, hi, points) for c in cols}
    best = {}
    for _ in range(passes):
        grid_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(float(v)) for v in grids[c]]))])
        cand = long.select("c", "x", F.explode(F.element_at(grid_map, F.col("c"))).alias("lam"))
        r = cand.groupBy("c", "lam").agg(F.var_pop(yeo_johnson_expr(F.col("x"), F.col("lam"))).alias("v")).collect()
        by_col: dict[str, list] = {}
        for row in r:
            by_col.setdefault(row["c"], []).append((row["lam"], row["v"]))
        for c in cols:
            s, n = s_of.get(c, (0.0, 0))
            lls = []
            for lam, v in sorted(by_col.get(c, [])):
                ll = -np.inf if v is None or not np.isfinite(v) or v <= 0 else -n / 2 * np.log(v) + (lam - 1) * s
                lls.append((ll, lam))
            if not lls:
                continue
            best[c] = float(max(lls)[1])
            step = grids[c][1] - grids[c][0]
            grids[c] = np.linspace(best[c] - step, best[c] + step, points)
    return best


def yeo_johnson(df: DataFrame, cols: Sequence[str], lambdas: dict[str, float] | None = None) -> DataFrame:
    """OUT-03: power transform per column (no standardising)."""
    lambdas = lambdas or fit_yeo_johnson(df, cols)
    return df.withColumns({c: yeo_johnson_expr(_q(c).cast("double"), lam) for c, lam in lambdas.items()})


def outlier_handle(df: DataFrame, method: str = "yeo", k: float = 1.5, exclude=()) -> DataFrame:
    """OUT-04: detect IQR outlier columns, transform only those (``log`` or ``yeo``)."""
    if method not in ("log", "yeo"):
        raise ValueError(f"unknown outlier method {method!r}")
    flagged = [r["column"] for r in iqr_outlier_columns(df, None, k, exclude).filter("is_outlier").collect()]
    if not flagged:
        return df
    return log_transform(df, flagged) if method == "log" else yeo_johnson(df, flagged)


# ------------------------------------------------------------------- scaling

def fit_standard(df: DataFrame, cols: Sequence[str], split: str | None = "split", fit_on: str = "train"
                 ) -> dict[str, tuple[float, float]]:
    src = df.filter(F.col(split) == fit_on) if split else df
    r = src.agg(*[x for c in cols for x in (F.avg(_q(c)).alias(f"{c}__m"), F.stddev_pop(_q(c)).alias(f"{c}__s"))]).first()
    return {c: (r[f"{c}__m"], r[f"{c}__s"]) for c in cols}


def standard_scale(df: DataFrame, cols=None, split: str | None = "split", fit_on: str = "train",
                   exclude=()) -> DataFrame:
    """SCL-01: ``(x - mean) / std_pop`` fitted on ``fit_on`` rows, applied to all; std 0 -> 1."""
    cols = _cols(df, cols, exclude)
    st = fit_standard(df, cols, split, fit_on)
    return df.withColumns({c: (_q(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in st.items()
                           if m is not None})


def robust_scale(df: DataFrame, cols=None, split: str | None = "split", fit_on: str = "train",
                 exclude=()) -> DataFrame:
    """SCL-02: ``(x - median) / IQR`` with exact quantiles; IQR 0 -> 1."""
    cols = _cols(df, cols, exclude)
    from .quantiles import exact_quantiles
    src = df.filter(F.col(split) == fit_on) if split else df
    qs = exact_quantiles(src, cols, [0.25, 0.5, 0.75])
    out = {}
    for c in cols:
        q = [qs[(c, 0.25)], qs[(c, 0.5)], qs[(c, 0.75)]]
        if q[0] is None:
            continue
        iqr = q[2] - q[0]
        out[c] = (_q(c) - F.lit(q[1])) / F.lit(iqr if iqr else 1.0)
    return df.withColumns(out)


# ------------------------------------------------------------------ selection

def select_k_best(df: DataFrame, target: str, k: int = 10, cols=None) -> DataFrame:
    """SEL-01: F statistic of a simple regression on each feature,
    ``F = r^2 / (1 - r^2) * (n - 2)``, top ``k`` selected (ties by column order)."""
    cols = _cols(df, cols, [target])
    if not cols:
        raise ValueError("no features")
    d = df.na.drop(subset=cols + [target])
    row = d.agg(F.count(F.lit(1)).alias("n"), *[F.corr(_q(c), _q(target)).alias(f"r{i}") for i, c in enumerate(cols)])
    long = row.select("n", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("feature"),
                                                        F.col(f"r{i}").alias("r")) for i, c in enumerate(cols)])).alias("s"))
    long = long.select("n", "s.*")
    f = F.try_divide(F.col("r") * F.col("r"), 1 - F.col("r") * F.col("r")) * (F.col("n") - 2)
    long = long.withColumn("f_score", f)
    rank = F.row_number().over(Window.orderBy(F.col("f_score").desc_nulls_last(), "i"))
    # the window runs over one row per feature (a handful of rows), not over data rows
    return long.withColumn("selected", rank <= k).select("feature", "f_score", "selected")


def variances(df: DataFrame, cols=None, threshold: float = 0.0) -> DataFrame:
    """SEL-02 fit as a table: population variance per feature and whether it is kept."""
    cols = _cols(df, cols)
    row = df.agg(*[F.var_pop(_q(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"))
                                          for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return long.withColumn("kept", F.coalesce(F.col("variance") > threshold, F.lit(False)))


def variance_threshold(df: DataFrame, threshold: float = 0.0, cols=None) -> DataFrame:
    """SEL-02: keep features whose population variance exceeds ``threshold``."""
    cols = _cols(df, cols)
    r = df.agg(*[F.var_pop(_q(c)).alias(c) for c in cols]).first().asDict()
    keep = [c for c in cols if r[c] is not None and r[c] > threshold]
    return df.select(*[c for c in df.columns if c not in cols or c in keep])
