"""Nearest-neighbour imputation without comparing all pairs of rows.

A receiver (a row with a gap) and a donor are compared on the columns that both hold, so for one pattern of gaps on either
side the distance is Euclidean on fixed columns and the triangle inequality holds. Donors of a pair of patterns are put into the
cell of their nearest pivot. From the number of donors and the radius of the cells a receiver gets a bound that holds its k-th nearest
donor, and it visits only the cells that can have a donor within the bound. Distances are taken between blocks of
receivers and parts of a cell's donors; the k best of each are merged.

Equal rows are one row (donors keep their k smallest ids), and sorted ranges cut cells into parts, so no cell or group of copies meets
in one task. Rows are replicated by the number of patterns of gaps in their keys, not by the number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: donors in a part, receivers in a block
PART, BLOCK = 4096, 256


def _vectors(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``df`` with ``_g`` (its keys as text), ``_x`` (the columns) and ``_gaps`` (1 for a gap; NaN is a gap)."""
    x = F.array(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols])
    return (df.withColumn("_g", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")).withColumn("_x", x)
            .withColumn("_gaps", F.array_join(F.transform("_x", lambda v: F.when(v.isNull(), "1").otherwise("0")), "")))


def distinct_donors(df: DataFrame, row_id: str, cols: Sequence[str], k: int, keys: Sequence[str] = ()) -> DataFrame:
    """``_g, _x, _gaps, ids``: each distinct row with a value, and its k smallest ids (row_id of any sortable type)."""
    kind = df.schema[row_id].dataType.simpleString()
    rows = _vectors(df, cols, keys).filter(F.contains("_gaps", F.lit("0"))).select("_g", "_x", "_gaps", F.col(f"`{row_id}`").alias("_id"))
    # copies are cut to k ids by a part of their ids first, so that a row with very many copies is never one list
    few = F.slice(F.array_sort(F.collect_list("_id")), 1, k)
    salted = rows.groupBy("_g", "_x", "_gaps", F.pmod(F.xxhash64("_id"), F.lit(256)).alias("_s")).agg(few.alias("ids"))
    return (salted.groupBy("_g", "_x", "_gaps").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k).alias("ids"))
            .select("_g", "_x", "_gaps", F.col("ids").cast(f"array<{kind}>").alias("ids")))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([[np.nan if v is None else v for v in row] for row in column], dtype=float)


def _shared(gaps: str, other: str) -> list[int]:
    return [j for j, (a, b) in enumerate(zip(gaps, other)) if a == "0" and b == "0"]


def _scale(m: int, shared: int) -> float:
    return float(np.sqrt(m / shared))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of two small blocks, by differences (products would lose digits)."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(out)


CELLS = "_g string, _r string, _gaps string, cell int, dist double, n int, _x array<double>"


def _to_cells(donors: DataFrame, wanted: DataFrame, pivots: np.ndarray, cols: int) -> DataFrame:
    """Every donor once for each receivers' pattern (``wanted``: _g, rs) that it can help, with its cell there."""
    kind = donors.schema["ids"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (gaps, rs), own in pdf.assign(_k=[tuple(r) for r in pdf["rs"]]).groupby(["_gaps", "_k"], sort=False):
                x = _matrix(own["_x"])
                for r in rs:
                    on = _shared(gaps, r)
                    if not on or not any(a == "1" and b == "0" for a, b in zip(r, gaps)):
                        continue
                    d = _distances(x[:, on], pivots[:, on])
                    cell = d.argmin(axis=1)
                    yield pd.DataFrame({"_g": own["_g"], "_r": r, "_gaps": gaps, "cell": cell.astype("int32"), "dist": d[np.arange(len(x)), cell],
                                        "n": [len(i) for i in own["ids"]], "_x": own["_x"], "ids": own["ids"]})

    return donors.join(wanted, "_g").mapInPandas(run, f"{CELLS}, ids {kind}")


def _visits(receivers: DataFrame, stats: DataFrame, pivots: np.ndarray, k: int, cols: int) -> DataFrame:
    """``_g, _r, _gaps, cell, vid, _x``: the cells that each receiver has to look at."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for g, r, block, cells in pdf[["_g", "_r", "block", "cells"]].itertuples(index=False, name=None):
                gaps = np.array([c["_gaps"] for c in cells])
                cell, least, radius = (np.array([c[f] for c in cells]) for f in ("cell", "least", "radius"))
                first = np.full((len(cells), k), np.inf)  # distances of a cell's first k donors to its pivot
                for i, c in enumerate(cells):
                    first[i, :len(c["first"])] = c["first"]
                rows = [b["_x"] for b in block]
                x = _matrix(rows)
                far = np.empty((len(x), len(cells)))
                near = np.empty((len(x), len(cells)))  # distance to the nearest pivot
                scale = np.empty(len(cells))
                for other in set(gaps):
                    on, own = _shared(r, other), gaps == other
                    d = _distances(x[:, on], pivots[:, on])
                    far[:, own], near[:, own] = d[:, cell[own]], d.min(axis=1)[:, None]
                    scale[own] = _scale(cols, len(on))
                # triangle inequality to the own pivot, and to the nearest one (a donor of the cell is no nearer to that)
                lower = np.maximum.reduce([far - radius, least - far, (far - near) / 2, np.zeros_like(far)]) * scale
                visit = np.zeros(far.shape, bool)
                for j in [j for j, a in enumerate(r) if a == "1"]:
                    able = np.flatnonzero([o[j] == "0" for o in gaps])
                    if not len(able):
                        continue
                    upper = ((far[:, able, None] + first[able]) * scale[able, None]).reshape(len(x), -1)
                    # k donors lie within the bound; fewer than k donors: all cells
                    bound = np.partition(upper, k - 1, axis=1)[:, k - 1:k] if upper.shape[1] >= k else np.inf
                    visit[:, able] |= lower[:, able] <= bound * (1 + 1e-9) + 1e-12
                who, where = np.nonzero(visit)
                yield pd.DataFrame({"_g": g, "_r": r, "_gaps": gaps[where], "cell": cell[where].astype("int32"),
                                    "vid": [block[i]["vid"] for i in who], "_x": [rows[i] for i in who]})

    blocks = _packed(receivers, ["_g", "_r"], ["vid", "_x"], BLOCK, "block")
    return (blocks.join(stats, ["_g", "_r"]).select("_g", "_r", "block", "cells")
            .mapInPandas(run, "_g string, _r string, _gaps string, cell int, vid string, _x array<double>"))


CELL = ["_g", "_r", "_gaps", "cell"]


def _packed(rows: DataFrame, keys: Sequence[str], payload: Sequence[str], size: int, name: str) -> DataFrame:
    """Rows of equal ``keys`` as lists of at most ``size``: sorted ranges, so a large group lies in several of them."""
    keys, payload = list(keys), list(payload)
    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in payload)
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        last = None

        def told() -> pd.DataFrame:
            return pd.DataFrame([(*last, [dict(zip(payload, x)) for x in held])], columns=[*keys, name])

        for pdf in batches:
            for key, row in zip(pdf[keys].itertuples(index=False, name=None), pdf[payload].itertuples(index=False, name=None)):
                if held and (key != last or len(held) >= size):
                    yield told()
                    held = []
                last = key
                held.append(row)
        if held:
            yield told()

    ranged = rows.select(*keys, *payload).repartitionByRange(*keys, payload[0]).sortWithinPartitions(*keys)
    return ranged.mapInPandas(run, f"{kinds}, {name} array<struct<{fields}>>")


def cell_stats(placed: DataFrame, k: int) -> DataFrame:
    """``_g, _r, cells``: of each cell the least and largest distance to its pivot, and the k smallest ones (an id each)."""
    first = F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, k).alias("first")
    ends = [F.min("least").alias("least"), F.max("radius").alias("radius"), first]
    one = placed.select(*CELL, F.pmod(F.xxhash64("_x"), F.lit(256)).alias("_s"), F.col("dist").alias("least"), F.col("dist").alias("radius"),
                        F.array_repeat("dist", F.least("n", F.lit(k))).alias("first"))
    return (one.groupBy(*CELL, "_s").agg(*ends).groupBy(*CELL).agg(*ends)
            .groupBy("_g", "_r").agg(F.collect_list(F.struct("_gaps", "cell", "least", "radius", "first")).alias("cells")))


def pick_pivots(donors: DataFrame, cols: int, pivots: int | None = None) -> np.ndarray:
    """Donors with the smallest hashes: about twice the root of their number, at most 1024. A gap there becomes the mean of the
    others. Any pivots give right results."""
    n = pivots or int(min(1024, 2 * np.sqrt(donors.count()) + 1))
    rows = donors.select("_x", F.xxhash64("_x").alias("h")).orderBy("h").limit(n).collect()
    picked = _matrix(pd.Series([r["_x"] for r in rows])) if rows else np.zeros((1, cols))
    mean = [c[~np.isnan(c)].mean() if (~np.isnan(c)).any() else 0.0 for c in picked.T]
    return np.where(np.isnan(picked), mean, picked)


def nearest(receivers: DataFrame, donors: DataFrame, cols: int, k: int, pivots: int | None = None) -> DataFrame:
    """``_g, vid, j, best``: for each receiver (_g, vid, _x, _gaps) and missing column j its k nearest donors that hold the
    column, as (d, id, v) by distance, then id."""
    kind = donors.schema["ids"].dataType.elementType.simpleString()
    wanted = receivers.groupBy("_g").agg(F.collect_set("_gaps").alias("rs"))
    picked = pick_pivots(donors, cols, pivots)
    placed = _to_cells(donors, wanted, picked, cols).checkpoint(eager=True)
    visits = _visits(receivers.withColumnRenamed("_gaps", "_r"), cell_stats(placed, k), picked, k, cols)
    pairs = _packed(visits, CELL, ["vid", "_x"], BLOCK, "block").join(_packed(placed, CELL, ["_x", "ids"], PART, "part"), CELL)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for g, r, gaps, block, part in pdf[["_g", "_r", "_gaps", "block", "part"]].itertuples(index=False, name=None):
                on = _shared(r, gaps)
                x, y = _matrix([b["_x"] for b in block]), _matrix([p["_x"] for p in part])
                d = _distances(x[:, on], y[:, on]) * _scale(cols, len(on))
                first = min(k, d.shape[1]) - 1
                bound = np.partition(d, first, axis=1)[:, first]  # each donor stands for one id at least
                out = []
                for i, b in enumerate(block):
                    near = np.flatnonzero(d[i] <= bound[i])
                    best = sorted((float(d[i, q]), one, q) for q in near for one in part[q]["ids"])[:k]
                    for j in range(cols):
                        if r[j] == "1" and gaps[j] == "0":
                            out.append((g, b["vid"], j, [{"d": e, "id": one, "v": float(y[q, j])} for e, one, q in best]))
                yield pd.DataFrame(out, columns=["_g", "vid", "j", "best"])

    found = pairs.select("_g", "_r", "_gaps", "block", "part").mapInPandas(
        compare, f"_g string, vid string, j int, best array<struct<d:double,id:{kind},v:double>>")
    return found.groupBy("_g", "vid", "j").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))


def fill_from(df: DataFrame, donors: DataFrame, cols: Sequence[str], k: int, keys: Sequence[str], means: dict, pivots: int | None = None) -> DataFrame:
    """``df`` with the gaps of ``cols`` filled from ``donors`` (see ``distinct_donors``)."""
    cols = list(cols)
    own = _vectors(df, cols, keys).withColumn("_vid", F.when(F.contains("_gaps", F.lit("1")), F.to_json(F.struct("_x"))))
    receivers = own.filter("_vid is not null").select("_g", F.col("_vid").alias("vid"), "_x", "_gaps").dropDuplicates(["_g", "vid"])
    best = nearest(receivers, donors, len(cols), k, pivots)
    mean = F.aggregate("best", F.lit(0.0), lambda s, e: s + e["v"]) / F.size("best")
    wide = best.withColumn("f", mean).groupBy(F.col("_g").alias("_bg"), F.col("vid").alias("_bv")).agg(
        *[F.max(F.when(F.col("j") == j, F.col("f"))).alias(f"_f{j}") for j in range(len(cols))])
    out = own.join(wide, (F.col("_g") == F.col("_bg")) & (F.col("_vid") == F.col("_bv")), "left")
    return out.withColumns({c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")), F.col(f"_f{j}"), F.lit(means[c]))
                            for j, c in enumerate(cols)}).select(*(F.col(f"`{c}`") for c in df.columns))


def impute_knn(df: DataFrame, row_id: str, cols=None, k: int = 5, keys: Sequence[str] = (), pivots: int | None = None) -> DataFrame:
    """IMP-03: each gap becomes the mean of the column in the k nearest donors that hold it, by the distance
    ``sqrt(m / |common| * sum_common (a - b)^2)`` over the m columns; ties go to the smaller ``row_id``. Donors are matched
    within ``keys``. A gap without a usable donor gets the column's mean. Exact, at every size."""
    from .features import _cols, fit_impute
    keys = list(keys)
    cols = _cols(df, cols, keys + [row_id])
    donors = distinct_donors(df, row_id, cols, k, keys).checkpoint(eager=True)
    return fill_from(df, donors, cols, k, keys, fit_impute(df, cols, "mean"), pivots)


# ------------------------------------------------------------------ saved form

class _KnnWriter(MLWriter):
    def __init__(self, model: KnnModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.donors.write.parquet(f"{path}/donors")


class _KnnReader(MLReader):
    def load(self, path: str) -> KnnModel:
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = KnnModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.donors = spark.read.parquet(f"{path}/donors")
        return model


class KnnModel(Model, MLWritable, MLReadable):
    """Gaps filled from the donors that were learned; they are saved as a table beside the parameters."""

    state = Param(Params._dummy(), "state", "columns, keys, k and means as JSON", TypeConverters.toString)

    def __init__(self, state: str = "{}", donors: DataFrame | None = None):
        super().__init__()
        self._set(state=state)
        self.donors = donors

    def write(self) -> MLWriter:
        return _KnnWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _KnnReader()

    def _transform(self, df: DataFrame) -> DataFrame:
        got = json.loads(self.getOrDefault("state"))
        return fill_from(df, self.donors, got["columns"], got["k"], got["keys"], got["means"])


class KnnImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the donors (the distinct rows with their k smallest ids). Options: ``row_id`` (needed), ``k``, ``keys``."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to fill (empty: all numeric ones)", TypeConverters.toListString)
    options = Param(Params._dummy(), "options", "row_id, k and keys as JSON", TypeConverters.toString)
    method = Param(Params._dummy(), "method", "knn", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, method="knn", inputCols=(), options="{}"):
        super().__init__()
        self._set(method=method, inputCols=list(inputCols), options=options)

    def _fit(self, df: DataFrame) -> KnnModel:
        from .features import _cols, fit_impute
        how = json.loads(self.getOrDefault("options"))
        row_id, k, keys = how["row_id"], how.get("k", 5), how.get("keys", [])
        cols = _cols(df, self.getOrDefault("inputCols") or None, [*keys, row_id])
        donors = distinct_donors(df, row_id, cols, k, keys).checkpoint(eager=True)
        return KnnModel(json.dumps({"columns": cols, "keys": keys, "k": k, "means": fit_impute(df, cols, "mean")}), donors)
