"""Fitted preparation and regression as ``pyspark.ml`` stages whose state is saved with the pipeline.

Each estimator learns a few numbers a column from distributed passes and gives a model that holds them as one JSON
parameter, so ``PipelineModel.save`` and ``load`` keep them and a new session transforms rows as the old one did. The columns are
``inputCols``, or all numeric columns but ``exclude``; rows that are learned from can be limited to the values ``fitOn`` of ``splitCol``.

Choosers by name (an unknown name is an error): ``imputer``, ``outlier_handler``, ``scaler``, ``feature_processor``, ``regressor``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as FE
from . import trees as TR
from .columns import numeric_columns


class _Columns(HasInputCols):
    exclude = Param(Params._dummy(), "exclude", "columns that are never taken", TypeConverters.toListString)
    splitCol = Param(Params._dummy(), "splitCol", "column that tells which rows are learned from (empty: all)", TypeConverters.toString)
    fitOn = Param(Params._dummy(), "fitOn", "values of splitCol that are learned from", TypeConverters.toListString)
    method = Param(Params._dummy(), "method", "the way of doing it", TypeConverters.toString)
    options = Param(Params._dummy(), "options", "further settings as JSON", TypeConverters.toString)

    def columns(self, df: DataFrame) -> list[str]:
        own = self.getInputCols() if self.isDefined("inputCols") else []
        skip = self.getOrDefault("exclude")
        return list(own) or [c for c in numeric_columns(df) if c not in skip]

    def learned(self, df: DataFrame) -> DataFrame:
        split = self.getOrDefault("splitCol")
        return df.filter(F.col(split).isin(*self.getOrDefault("fitOn"))) if split else df

    def option(self, name: str, default=None):
        return json.loads(self.getOrDefault("options")).get(name, default)


class _Stage(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose ``methods`` are the names it takes."""

    methods: tuple[str, ...] = ()

    @keyword_only
    def __init__(self, *, method=None, inputCols=None, exclude=(), splitCol="", fitOn=("train",), options="{}"):
        super().__init__()
        self._setDefault(exclude=[], splitCol="", fitOn=["train"], options="{}", method=self.methods[0])
        given = {k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items() if v is not None}
        if given.get("method", self.methods[0]) not in self.methods:
            raise ValueError(f"unknown method {given['method']!r} (known: {', '.join(self.methods)})")
        self._set(**given)

    def _fit(self, df: DataFrame) -> Model:
        return self.model(state=json.dumps(self.learn(self.learned(df), self.columns(df), self.getOrDefault("method"))))


class _Fitted(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "what was learned, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def learned(self):
        return json.loads(self.getOrDefault("state"))


# ------------------------------------------------------------------ imputation

class ImputerModel(_Fitted):
    """Nulls take the column's learned value, or their mean given the row's other values."""

    def _transform(self, df: DataFrame) -> DataFrame:
        got = self.learned()
        if "sigma" in got:
            return FE.fill_iterative(df, got)
        return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v).cast(df.schema[c].dataType)) for c, v in got.items() if v is not None})


class ColumnImputer(_Stage):
    """IMP-01, IMP-02, IMP-04: ``mean``, ``median`` (exact) or ``iterative`` (from the row's other values)."""

    methods = ("mean", "median", "iterative")
    model = ImputerModel

    def learn(self, df: DataFrame, cols: list[str], method: str) -> dict:
        if method != "iterative":
            return FE.fit_impute(df, cols, method)
        return FE.fit_iterative(df.checkpoint(eager=True), cols, self.option("max_iter", 50), self.option("tol", 1e-6))


# -------------------------------------------------------------------- outliers

class OutlierModel(_Fitted):
    """The learned transform of the columns that held outliers; a value outside a logarithm's range becomes null."""

    def _transform(self, df: DataFrame) -> DataFrame:
        got = self.learned()
        return df.withColumns({c: F.ln(F.when(F.col(f"`{c}`") > 0, F.col(f"`{c}`"))) if lam is None
                               else FE.yeo_johnson_expr(F.col(f"`{c}`").cast("double"), lam) for c, lam in got.items()})


class OutlierHandler(_Stage):
    """OUT-04: columns with a value outside the quartile fence get ``yeo`` (Yeo-Johnson, lambda by likelihood) or ``log``
    (only where all learned values are positive)."""

    methods = ("yeo", "log")
    model = OutlierModel

    def learn(self, df: DataFrame, cols: list[str], method: str) -> dict:
        flagged = [r["column"] for r in FE.iqr_outlier_columns(df, cols, self.option("k", 1.5)).filter("is_outlier").collect()]
        if not flagged:
            return {}
        if method == "yeo":
            return FE.fit_yeo_johnson(df, flagged)
        least = df.agg(*(F.min(F.col(f"`{c}`")).alias(c) for c in flagged)).first().asDict()
        return {c: None for c in flagged if least[c] is not None and least[c] > 0}


# --------------------------------------------------------------------- scaling

class ScalerModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(f"`{c}`") - F.lit(center)) / F.lit(spread) for c, (center, spread) in self.learned().items()})


class ColumnScaler(_Stage):
    """SCL-01, SCL-02: ``standard`` (mean, population deviation) or ``robust`` (median, quartile distance); a spread of 0 counts as 1."""

    methods = ("standard", "robust")
    model = ScalerModel

    def learn(self, df: DataFrame, cols: list[str], method: str) -> dict:
        if method == "standard":
            got = FE.fit_standard(df, cols, split=None)
        else:
            from .quantiles import exact_quantiles
            q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
            got = {c: (q[(c, 0.5)], None if q[(c, 0.5)] is None else q[(c, 0.75)] - q[(c, 0.25)]) for c in cols}
        return {c: (m, s or 1.0) for c, (m, s) in got.items() if m is not None}


# ------------------------------------------------------- selection, extraction

class SelectorModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        gone = set(self.learned()["dropped"])
        return df.select(*(F.col(f"`{c}`") for c in df.columns if c not in gone))


class FeatureSelector(_Stage):
    """SEL-01, SEL-02: ``selectkbest`` (option ``k``, needs ``target``) or ``variancethreshold`` (option ``threshold``)."""

    methods = ("selectkbest", "variancethreshold")
    model = SelectorModel

    def learn(self, df: DataFrame, cols: list[str], method: str) -> dict:
        if method == "selectkbest":
            target = self.option("target")
            if not target:
                raise ValueError("selectkbest needs the option target")
            cols = [c for c in cols if c != target]
            kept = {r["feature"] for r in FE.select_k_best(df, target, self.option("k", 10), cols).filter("selected").collect()}
        else:
            kept = {r["feature"] for r in FE.variances(df, cols, self.option("threshold", 0.0)).filter("kept").collect()}
        return {"dropped": [c for c in cols if c not in kept]}


class ProjectorModel(_Fitted):
    """Rows projected by the learned matrix; the input columns go. A row with a null among them gets nulls."""

    def _transform(self, df: DataFrame) -> DataFrame:
        from .project import rbf
        got = self.learned()
        cols, name = got["columns"], got["prefix"]
        center, w = np.asarray(got["center"]), np.asarray(got["w"])
        marks, proj = (np.asarray(got[k]) if k in got else None for k in ("landmarks", "proj"))
        gamma = got.get("gamma")

        @F.pandas_udf("array<double>")
        def project(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for parts in batches:
                x = np.column_stack([p.to_numpy(dtype=float, na_value=np.nan) for p in parts])
                z = x if marks is None else rbf(x, marks, gamma) @ proj
                yield pd.Series(list((z - center) @ w))

        out = df.withColumn("__z", project(*(F.col(f"`{c}`").cast("double") for c in cols)))
        return out.withColumns({f"{name}{i + 1}": F.nanvl(F.col("__z")[i], F.lit(None).cast("double")) for i in range(w.shape[1])}).drop("__z", *cols)


class FeatureProjector(_Stage):
    """EXT-01, EXT-02: ``lda`` (option ``target``) or ``kernelpca`` (options ``row_id``, ``n_components``, ``gamma``, ``tol``)."""

    methods = ("lda", "kernelpca")
    model = ProjectorModel

    def learn(self, df: DataFrame, cols: list[str], method: str) -> dict:
        from . import project as PJ
        cols = [c for c in cols if c not in (self.option("target"), self.option("row_id"))]
        if method == "lda":
            mu, w = PJ.fit_lda(df, cols, self.option("target"), self.option("n_components"))
            return {"columns": cols, "prefix": "LDA", "center": mu.tolist(), "w": w.tolist()}
        fit = PJ.fit_kernel_pca(df, cols, self.option("row_id"), self.option("n_components", 5), self.option("gamma"), self.option("tol", 1e-3))
        return {"columns": cols, "prefix": "KPC", "center": fit.mean.tolist(), "w": fit.w.tolist(),
                "landmarks": fit.landmarks.tolist(), "proj": fit.proj.tolist(), "gamma": fit.gamma}


# ------------------------------------------------------------------ regressors

class RegressorModel(_Fitted, HasPredictionCol):
    """Adds ``prediction``: linear, or the sum of trees. A linear prediction over a null is null."""

    def _transform(self, df: DataFrame) -> DataFrame:
        got = self.learned()
        if got["kind"] == "linear":
            value = F.lit(got["intercept"])
            for c, w in zip(got["features"], got["coef"]):
                value = value + F.lit(w) * F.col(f"`{c}`")
        else:
            value = TR.predictor(got)(*(F.col(f"`{c}`").cast("double") for c in got["features"]))
        return df.withColumn(self.getPredictionCol(), value)


class Regressor(_Stage, HasLabelCol):
    """MOD-01 to MOD-03: ``lasso``, ``ridge`` or ``xgboost`` (boosted trees) with the model's parameters as options (an unknown name is an
    error). Rows with a null feature or label are left out by the linear models; trees take null features as a value of their own."""

    methods = ("lasso", "ridge", "xgboost")
    model = RegressorModel

    @keyword_only
    def __init__(self, *, method=None, inputCols=None, exclude=(), splitCol="", fitOn=("train",), options="{}", labelCol="label"):
        given = dict(self._input_kwargs)
        label = given.pop("labelCol", labelCol)
        super().__init__(**given)
        self._set(labelCol=label)

    def learn(self, df: DataFrame, cols: list[str], method: str) -> dict:
        from . import models as M
        label = self.getLabelCol()
        cols = [c for c in cols if c != label]
        params = json.loads(self.getOrDefault("options"))
        if method == "xgboost":
            return {"kind": "trees", "features": cols, **TR.fit_trees(df, cols, label, params)}
        coef, intercept = M.fit_linear(method, params, M.GramStats(M.gram(df, cols, label).first(), len(cols)))
        return {"kind": "linear", "features": cols, "coef": [float(w) for w in coef], "intercept": float(intercept)}


# -------------------------------------------------------------------- choosers

def _named(known: dict, name: str, what: str, **how):
    if name not in known:
        raise ValueError(f"unknown {what} {name!r} (known: {', '.join(known)})")
    return known[name](method=name, **how)


def imputer(name: str, **how) -> Estimator:
    from .knn import KnnImputer
    known = {m: ColumnImputer for m in ColumnImputer.methods} | {"knn": KnnImputer}
    return _named(known, name, "imputer", **how)


def outlier_handler(name: str, **how) -> Estimator:
    return _named({m: OutlierHandler for m in OutlierHandler.methods}, name, "outlier method", **how)


def scaler(name: str, **how) -> Estimator:
    return _named({m: ColumnScaler for m in ColumnScaler.methods}, name, "scaler", **how)


def feature_processor(name: str, **how) -> Estimator:
    known = {m: FeatureSelector for m in FeatureSelector.methods} | {m: FeatureProjector for m in FeatureProjector.methods}
    return _named(known, name, "feature processor", **how)


def regressor(name: str, params: dict, features: Sequence[str], label: str, **how) -> Estimator:
    return _named({m: Regressor for m in Regressor.methods}, name, "model", inputCols=list(features), labelCol=label,
                  options=json.dumps(params), **how)
