"""Distributed normal equations: per-key sums ``n, X'X, X'y, y'y``. Every task adds up its
batches with numpy and sends one row per key; the entries are summed map-side by key and place,
so what meets in one task is p x p numbers a key, however many tasks there are."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gram(df: DataFrame, features: Sequence[str], label: str | None = None,
         keys: Sequence[str] = (), intercept: bool = True) -> DataFrame:
    """One row per key: ``n``, ``xtx`` (row-major p*p), ``xty`` (p), ``yty`` and
    ``xsum`` (p). Rows with a null feature or label are skipped. With ``intercept`` the
    first feature is a constant 1."""
    keys, features = list(keys), list(features)
    p = len(features) + (1 if intercept else 0)
    lab = label
    key_fields = [df.schema[k] for k in keys]
    cols = keys + features + ([lab] if lab else [])
    src = df.select(*[F.col(f"`{c}`") for c in cols]).na.drop(subset=features + ([lab] if lab else []))

    def partial(it):
        sums: dict[tuple, np.ndarray] = {}  # a task sends one row for each of its keys
        for pdf in it:
            if pdf.empty:
                continue
            groups = pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]
            for k, g in groups:
                x = g[features].to_numpy(dtype=float)
                if intercept:
                    x = np.hstack([np.ones((len(x), 1)), x])
                y = g[lab].to_numpy(dtype=float) if lab else np.zeros(len(x))
                own = np.concatenate([[len(x)], (x.T @ x).ravel(), x.T @ y, [y @ y], x.sum(axis=0)])
                k = tuple(None if v != v else v for v in (k if isinstance(k, tuple) else (k,))[:len(keys)])
                sums[k] = sums[k] + own if k in sums else own
        if sums:
            yield pd.DataFrame([[*k, v.tolist()] for k, v in sums.items()], columns=[*keys, "__v"])

    parts = src.mapInPandas(partial, T.StructType([*key_fields, T.StructField("__v", T.ArrayType(T.DoubleType()))]))
    entries = (parts.select(*keys, F.posexplode("__v").alias("__i", "__x"))
               .groupBy(*keys, "__i").agg(F.sum("__x").alias("__x")))
    whole = entries.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__i", "__x"))), lambda e: e["__x"]).alias("__v"))
    v = F.col("__v")
    return whole.select(
        *keys, v[0].cast("long").alias("n"), F.slice(v, 2, p * p).alias("xtx"), F.slice(v, 2 + p * p, p).alias("xty"),
        v[1 + p * p + p].alias("yty"), F.slice(v, 3 + p * p + p, p).alias("xsum"))


def solve(g: DataFrame, keys: Sequence[str], p: int, ridge: float | Sequence[float] = 0.0,
          penalize_first: bool = False, name: str = "coef") -> DataFrame:
    """Per key: ``(X'X + ridge*I) b = X'y`` solved in the task (numpy), least squares when
    singular. Output keys, n, coef, sse (residual sum of squares)."""
    keys = list(keys)
    key_fields = [g.schema[k] for k in keys]
    schema = T.StructType(key_fields + [T.StructField("n", T.LongType()),
                                        T.StructField(name, T.ArrayType(T.DoubleType())),
                                        T.StructField("sse", T.DoubleType())])
    lam = np.asarray(ridge, dtype=float) * np.ones(p)
    if not penalize_first:
        lam[0] = 0.0

    def run(it):
        for pdf in it:
            out = []
            for d in pdf.to_dict("records"):
                a = np.asarray(d["xtx"], dtype=float).reshape(p, p)
                b = np.asarray(d["xty"], dtype=float)
                try:
                    coef = np.linalg.solve(a + np.diag(lam), b)
                except np.linalg.LinAlgError:
                    coef = np.linalg.lstsq(a + np.diag(lam), b, rcond=None)[0]
                sse = float(d["yty"] - 2 * coef @ b + coef @ a @ coef)
                out.append([d[k] for k in keys] + [int(d["n"]), coef.tolist(), sse])
            yield pd.DataFrame(out, columns=keys + ["n", name, "sse"])

    return g.mapInPandas(run, schema)


def sum_vectors(df: DataFrame, vector, length: int, piece: int = 4096) -> np.ndarray:
    """The sum of ``length`` numbers over all rows: ``vector`` gives them for a pandas batch. Every task adds up its own batches and
    sends its sum in pieces; a piece is added up in two steps, so neither a task nor the driver meets all tasks' sums."""
    cuts = range(0, length, piece)

    def partial(it):
        total = np.zeros(length)
        for pdf in it:
            if len(pdf):
                total += vector(pdf)
        part = TaskContext.get().partitionId()
        yield pd.DataFrame({"piece": range(len(cuts)), "salt": part % 32, "sum": [total[c:c + piece].tobytes() for c in cuts]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, float) for x in pdf["sum"]], axis=0)
        return pd.DataFrame({"piece": pdf["piece"][:1], "salt": pdf["salt"][:1], "sum": [total.tobytes()]})

    kind = "piece int, salt int, sum binary"
    parts = df.mapInPandas(partial, kind).groupBy("piece", "salt").applyInPandas(add, kind)
    got = parts.groupBy("piece").applyInPandas(add, kind).collect()  # the sum itself, in pieces
    out = np.zeros(length)
    for r in got:
        out[r["piece"] * piece:r["piece"] * piece + piece] = np.frombuffer(r["sum"], float)
    return out
