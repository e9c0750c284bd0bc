"""Projections: linear discriminant analysis and RBF kernel PCA.

Both fit on small summaries (per-class Gram matrices; the moments of kernel features) and
project rows inside their own tasks with numpy on Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .gram import gram, sum_vectors


def expand_vector(df: DataFrame, vec: str, dim: int, prefix: str = "__e") -> tuple[DataFrame, list[str]]:
    names = [f"{prefix}{i}" for i in range(dim)]
    return df.withColumns({n: F.col(vec)[i].cast("double") for i, n in enumerate(names)}), names


def _project(df: DataFrame, keep: Sequence[str], feats: Sequence[str], center: np.ndarray, w: np.ndarray,
             prefix: str) -> DataFrame:
    keep, feats = list(keep), list(feats)
    k = w.shape[1]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(f"{prefix}{i + 1}", T.DoubleType())
                                                          for i in range(k)])

    def run(it):
        for pdf in it:
            z = (pdf[feats].to_numpy(dtype=float) - center) @ w
            out = pdf[keep].copy()
            for i in range(k):
                out[f"{prefix}{i + 1}"] = z[:, i]
            yield out

    return df.select(*keep, *feats).mapInPandas(run, schema)


def fit_lda(df: DataFrame, feats: Sequence[str], label: str, n_components: int | None = None):
    """EXT-01 fit: within-class covariance ``Sw`` (pooled, divided by n - C) and
    between-class scatter ``Sb`` from per-class Gram matrices; directions solve
    ``Sb w = l Sw w`` normalised to ``w' Sw w = 1``, largest ``l`` first."""
    feats = list(feats)
    d = len(feats)
    g = gram(df, feats, None, [label], intercept=False).collect()  # one row per class
    n_c = np.array([r["n"] for r in g], dtype=float)
    sums = np.array([r["xsum"] for r in g], dtype=float)
    n, C = n_c.sum(), len(g)
    means = sums / n_c[:, None]
    mu = sums.sum(axis=0) / n
    sw = np.zeros((d, d))
    sb = np.zeros((d, d))
    for r, nc, m in zip(g, n_c, means):
        sw += np.asarray(r["xtx"], dtype=float).reshape(d, d) - nc * np.outer(m, m)
        sb += nc * np.outer(m - mu, m - mu)
    sw /= max(n - C, 1.0)
    k = min(C - 1, d) if n_components is None else min(n_components, C - 1, d)
    # generalised symmetric eigenproblem through the Cholesky factor of Sw
    L = np.linalg.cholesky(sw + 1e-12 * np.eye(d) * np.trace(sw) / d)
    Li = np.linalg.inv(L)
    vals, vecs = np.linalg.eigh(Li @ sb @ Li.T)
    idx = np.argsort(vals)[::-1][:k]
    w = Li.T @ vecs[:, idx]
    return mu, w


def lda_projection(df: DataFrame, vec: str, dim: int, label: str, keep: Sequence[str],
                   n_components: int | None = None) -> DataFrame:
    """EXT-01: rows projected to ``LDA1..LDAk`` (k = min(classes - 1, features))."""
    x, feats = expand_vector(df, vec, dim)
    mu, w = fit_lda(x, feats, label, n_components)
    return _project(x, keep, feats, mu, w, "LDA")


def rbf(x: np.ndarray, marks: np.ndarray, gamma: float) -> np.ndarray:
    d2 = (x ** 2).sum(1)[:, None] + (marks ** 2).sum(1)[None, :] - 2 * x @ marks.T
    return np.exp(-gamma * np.maximum(d2, 0.0))


@dataclass
class KernelFit:
    """``rbf(x, landmarks) @ proj`` are the features of a row, ``(features - mean) @ w`` its components; ``residual``
    is the mean of what the kernel's diagonal loses by the landmarks (at most the tolerance that was asked for)."""

    landmarks: np.ndarray
    proj: np.ndarray
    mean: np.ndarray
    w: np.ndarray
    gamma: float
    residual: float


def _features_of(marks: np.ndarray, gamma: float) -> np.ndarray:
    """The matrix that makes kernel values into features whose products give the kernel on the landmarks' span."""
    vals, vecs = np.linalg.eigh(rbf(marks, marks, gamma))
    keep = vals > 1e-10 * vals.max()
    return vecs[:, keep] / np.sqrt(vals[keep])


def pick_landmarks(df: DataFrame, feats: Sequence[str], row_id: str, gamma: float, tol: float, most: int, step: int = 64) -> tuple[np.ndarray, float]:
    """Rows that span the kernel: pivoted partial Cholesky in rounds. A round takes the ``step`` rows with the largest
    residual ``k(x, x) - |features(x)|^2`` (a top-k of the table), adds them one by one while their residual under those just
    added stays large, and goes on until the mean residual is at most ``tol`` or there are ``most`` landmarks."""
    feats = list(feats)
    marks = np.zeros((0, len(feats)))
    kind = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("id", df.schema[row_id].dataType),
                         T.StructField("left", T.DoubleType()), T.StructField("sum", T.DoubleType()), T.StructField("n", T.LongType())])
    rows = df.select(F.col(f"`{row_id}`").alias("__id"), *feats).na.drop(subset=feats)
    while True:
        proj = _features_of(marks, gamma) if len(marks) else None

        def residuals(it, marks=marks, proj=proj):
            best, total, n = [], 0.0, 0
            for pdf in it:
                x = pdf[feats].to_numpy(dtype=float)
                left = np.ones(len(x)) if proj is None else np.maximum(1.0 - ((rbf(x, marks, gamma) @ proj) ** 2).sum(1), 0.0)
                total, n = total + left.sum(), n + len(x)
                top = np.argsort(-left, kind="stable")[:step]
                ids = pdf["__id"].tolist()
                best = sorted(best + [(-left[i], ids[i], x[i].tolist()) for i in top], key=lambda b: b[:2])[:step]
            yield pd.DataFrame([(x, i, -l, total if k == 0 else 0.0, n if k == 0 else 0) for k, (l, i, x) in enumerate(best)],
                               columns=["x", "id", "left", "sum", "n"])

        told = rows.mapInPandas(residuals, kind).checkpoint(eager=True)  # at most ``step`` rows a task
        total, n = told.agg(F.sum("sum"), F.sum("n")).first()
        if not n:
            raise ValueError("no row without a gap to learn from")
        mean = total / n
        if mean <= tol or len(marks) >= most:
            return marks, mean
        added = 0
        for r in told.orderBy(F.desc("left"), "id").limit(min(step, most - len(marks))).collect():
            x = np.array([r["x"]])
            if added:
                k = rbf(x, marks, gamma) @ _features_of(marks, gamma)
                if 1.0 - float((k ** 2).sum()) < max(0.3 * r["left"], 1e-9):
                    continue  # those just added explain it
            marks = np.vstack([marks, x])
            added += 1


def fit_kernel_pca(df: DataFrame, feats: Sequence[str], row_id: str, n_components: int = 5, gamma: float | None = None,
                   tol: float = 1e-3, most: int = 1000) -> KernelFit:
    """EXT-02 fit: RBF kernel PCA (``gamma = 1 / features``) on the centred kernel, through features on landmarks that
    are chosen until the kernel's diagonal is met to ``tol`` in the mean (``residual`` of the fit tells if ``most`` came first).
    The components of the exact kernel's trace differ by no more than that share. One pass sums the moments of the features."""
    feats = list(feats)
    gamma = gamma if gamma is not None else 1.0 / len(feats)
    rows = df.select(F.col(f"`{row_id}`"), *feats).na.drop(subset=feats).checkpoint(eager=True)  # a pass a round
    marks, residual = pick_landmarks(rows, feats, row_id, gamma, tol, most)
    proj = _features_of(marks, gamma)
    q = proj.shape[1]

    def moments(pdf):
        z = rbf(pdf.to_numpy(dtype=float), marks, gamma) @ proj
        return np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])

    sums = sum_vectors(rows.select(*feats), moments, 1 + q + q * q)
    n, mean = sums[0], sums[1:1 + q] / sums[0]
    vals, vecs = np.linalg.eigh(sums[1 + q:].reshape(q, q) - n * np.outer(mean, mean))
    w = vecs[:, np.argsort(vals)[::-1][:n_components]]
    w = w * np.where(w[np.abs(w).argmax(axis=0), np.arange(w.shape[1])] < 0, -1.0, 1.0)  # a sign that does not change from run to run
    return KernelFit(marks, proj, mean, w, gamma, residual)


def kernel_pca(df: DataFrame, vec: str, dim: int, row_id: str, keep: Sequence[str], n_components: int = 5,
               gamma: float | None = None, tol: float = 1e-3, most: int = 1000, n_landmarks: int | None = None) -> DataFrame:
    """EXT-02: rows projected to ``KPC1..``; see ``fit_kernel_pca``. ``n_landmarks`` asks for a number of landmarks
    instead of a tolerance: exact when every row is one."""
    x, feats = expand_vector(df, vec, dim)
    if n_landmarks is not None:
        tol, most = 0.0, n_landmarks
    fit = fit_kernel_pca(x, feats, row_id, n_components, gamma, tol, most)
    keep = list(keep)
    out_schema = T.StructType([x.schema[c] for c in keep] + [T.StructField(f"KPC{i + 1}", T.DoubleType()) for i in range(fit.w.shape[1])])

    def project(it):
        for pdf in it:
            z = (rbf(pdf[feats].to_numpy(dtype=float), fit.landmarks, fit.gamma) @ fit.proj - fit.mean) @ fit.w
            yield pd.concat([pdf[keep], pd.DataFrame(z, columns=[f"KPC{i + 1}" for i in range(z.shape[1])], index=pdf.index)], axis=1)

    return x.select(*keep, *feats).mapInPandas(project, out_schema)
