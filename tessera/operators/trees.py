"""Gradient boosted regression trees for whole parameter grids.

Features are cut once into histogram bins at quantiles of the training rows. A tree grows level by level: for each node, feature
and bin the gradients and hessians are added up, and the best split of a node is the one with the most gain
``T(GL)^2/(HL+l) + T(GR)^2/(HR+l) - T(G)^2/(H+l)``, with ``T`` the soft threshold by ``reg_alpha`` and ``l = reg_lambda``. A
leaf weighs ``-T(G)/(H+l)``; splits with less gain than ``gamma`` are pruned from the bottom. Loss: half the squared error.

Many parameter sets are fitted together, and sets that differ in ``n_estimators`` alone are one booster:

* Beyond ``local_cells`` training cells, all boosters grow in step. One pass over the binned rows serves a level of all of
  them: a task adds up its rows into one histogram a booster, the histograms are summed by booster and the splits chosen there,
  and only splits come to the driver. The rows' predictions are written every few trees.
* Up to ``local_cells`` the binned rows (a byte a cell, a checked size) are broadcast, and each task grows whole boosters.

Both take the same draws (a row's draw is a hash of its number, the tree and the seed) and the same steps.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import table_path

#: parameters and their defaults
DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "gamma": 0.0,
            "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "seed": 42}
#: a gain below this is rounding
LEAST_GAIN = 1e-6
#: bytes of binned training rows that are broadcast at most
LOCAL_CELLS = 8_000_000
BINS = 64


def checked(params: dict) -> dict:
    """``params`` over the defaults; an unknown name is an error."""
    if unknown := set(params) - set(DEFAULTS):
        raise ValueError(f"unknown tree parameters: {sorted(unknown)}")
    p = DEFAULTS | params
    if not 0 < p["subsample"] <= 1 or not 0 < p["colsample_bytree"] <= 1 or not 1 <= p["max_depth"] <= 12:
        raise ValueError("subsample and colsample_bytree lie in (0, 1], max_depth in 1 to 12")
    return p


# ------------------------------------------------------------------- binning

def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Ascending cuts of each feature at its quantiles: at most ``bins - 2`` numbers a feature, from one pass."""
    if not 3 <= bins <= 256:
        raise ValueError("bins lie in 3 to 256")
    probs = F.array(*(F.lit(k / (bins - 1)) for k in range(1, bins - 1)))
    got = df.agg(*(F.percentile_approx(F.col(f"`{c}`").cast("double"), probs, F.lit(50 * bins)).alias(f"q{i}")
                   for i, c in enumerate(features))).first()
    return [sorted({x for x in q or [] if x == x}) for q in got]


def to_bins(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of a rows x features array: 0 for missing values, else 1 + the number of cuts below the value."""
    out = np.zeros(values.shape, np.uint8)
    for j, e in enumerate(edges):
        own = values[:, j]
        out[:, j] = np.where(np.isnan(own), 0, 1 + np.searchsorted(np.asarray(e, float), own, side="left"))
    return out


# ----------------------------------------------------------------- one booster

def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def draws(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row number, the same wherever the row is."""
    x = rows.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03) & (2 ** 64 - 1))
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0 ** 53


class Tree:
    """A tree in heap order: the children of node i are 2i + 1 (bin <= ``cut``) and 2i + 2."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature = np.full(size, -1)
        self.cut = np.zeros(size, np.int64)
        self.gain = np.zeros(size)
        self.value = np.zeros(size)
        self.open = [0]  # nodes of the level that is to be split

    def nodes(self, bins: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node that each row has reached after ``levels`` levels."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(self.depth if levels is None else levels):
            f = self.feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (bins[rows, np.maximum(f, 0)] > self.cut[at]), at)
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]

    def prune(self, gamma: float) -> None:
        """From the bottom: a split below ``gamma`` whose children are leaves becomes a leaf."""
        for i in range(len(self.feature) // 2 - 1, -1, -1):
            if self.feature[i] >= 0 and self.gain[i] < gamma and self.feature[2 * i + 1] < 0 and self.feature[2 * i + 2] < 0:
                self.feature[i] = -1

    def packed(self) -> dict:
        """The reached nodes alone, in order, for storing."""
        keep = [0]
        for i in keep:
            if self.feature[i] >= 0:
                keep += [2 * i + 1, 2 * i + 2]
        return {"depth": self.depth, "node": [int(i) for i in keep], "feature": [int(self.feature[i]) for i in keep],
                "cut": [int(self.cut[i]) for i in keep], "value": [float(self.value[i]) for i in keep]}

    @classmethod
    def unpacked(cls, d: dict) -> Tree:
        t = cls(d["depth"])
        at = np.asarray(d["node"])
        t.feature[at], t.cut[at], t.value[at] = d["feature"], d["cut"], d["value"]
        return t


def histogram(bins: np.ndarray, node: np.ndarray, open_nodes: Sequence[int], g: np.ndarray, w: np.ndarray, size: int) -> np.ndarray:
    """Sums of gradients and of hessians, 2 x open nodes x features x bins, over the rows of weight ``w`` 1."""
    place = np.full(int(max(open_nodes)) + 1, -1)
    place[list(open_nodes)] = np.arange(len(open_nodes))
    own = np.where(node < len(place), place[np.minimum(node, len(place) - 1)], -1)
    use = (own >= 0) & w
    f = bins.shape[1]
    cell = ((own[use, None] * f + np.arange(f)) * size + bins[use]).ravel()
    n = len(open_nodes) * f * size
    out = np.empty((2, len(open_nodes), f, size))
    out[0] = np.bincount(cell, np.repeat(g[use], f), n).reshape(out.shape[1:])
    out[1] = np.bincount(cell, minlength=n).reshape(out.shape[1:])
    return out


def best_splits(hist: np.ndarray, columns: np.ndarray, p: dict) -> list[tuple]:
    """For each open node: gain (0: none), feature, cut, and gradient and hessian sums of the node, left and right."""
    left = hist.cumsum(axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left

    def score(s):
        return soft(s[0], p["reg_alpha"]) ** 2 / (s[1] + p["reg_lambda"] + 1e-300)

    gain = score(left) + score(right) - score(whole)
    able = (left[1] >= p["min_child_weight"]) & (right[1] >= p["min_child_weight"]) & columns[None, :, None]
    gain = np.where(able, gain, 0.0).reshape(len(gain), -1)
    best = gain.argmax(axis=1)
    out = []
    for i, b in enumerate(best):
        f, cut = divmod(int(b), hist.shape[3])
        top = float(gain[i, b])
        out.append((top if top > LEAST_GAIN else 0.0, f, cut, *map(float, (*whole[:, i, 0, 0], *left[:, i, f, cut], *right[:, i, f, cut]))))
    return out


def weight(g: float, h: float, p: dict) -> float:
    return float(-soft(np.float64(g), p["reg_alpha"]) / (h + p["reg_lambda"])) if h + p["reg_lambda"] > 0 else 0.0


def apply_splits(tree: Tree, splits: Sequence[tuple], p: dict) -> None:
    """Splits the open nodes; those opened are the children."""
    opened = []
    for node, (gain, f, cut, g, h, gl, hl, gr, hr) in zip(tree.open, splits):
        tree.value[node] = p["learning_rate"] * weight(g, h, p)
        if gain > 0:
            tree.feature[node], tree.cut[node], tree.gain[node] = f, cut, gain
            for child, own in ((2 * node + 1, (gl, hl)), (2 * node + 2, (gr, hr))):
                tree.value[child] = p["learning_rate"] * weight(*own, p)
                opened.append(child)
    tree.open = opened


def tree_columns(p: dict, tree: int, features: int) -> np.ndarray:
    """The features that a tree may use."""
    keep = max(1, round(p["colsample_bytree"] * features))
    out = np.zeros(features, bool)
    out[np.random.default_rng((p["seed"], tree)).permutation(features)[:keep]] = True
    return out


def sampled(rows: np.ndarray, p: dict, tree: int) -> np.ndarray:
    return np.ones(len(rows), bool) if p["subsample"] >= 1 else draws(rows, tree, p["seed"]) < p["subsample"]


def grow(bins: np.ndarray, y: np.ndarray, rows: np.ndarray, base: float, p: dict, size: int) -> list[Tree]:
    """A whole booster over rows that are at hand."""
    pred, out = np.full(len(y), base), []
    for t in range(p["n_estimators"]):
        tree, columns, use, g = Tree(p["max_depth"]), tree_columns(p, t, bins.shape[1]), sampled(rows, p, t), pred - y
        for level in range(p["max_depth"]):
            if not tree.open:
                break
            hist = histogram(bins, tree.nodes(bins, level), tree.open, g, use, size)
            apply_splits(tree, best_splits(hist, columns, p), p)
        tree.prune(p["gamma"])
        pred += tree.predict(bins)
        out.append(tree)
    return out


def predictions(trees: Sequence[Tree], bins: np.ndarray, base: float, at: Sequence[int]) -> dict[int, np.ndarray]:
    """The predictions after each number of trees of ``at``."""
    pred, out = np.full(len(bins), base), {}
    for k, tree in enumerate(trees, 1):
        pred = pred + tree.predict(bins)
        if k in at:
            out[k] = pred
    return out


# ----------------------------------------------------------------- whole grids

def boosters(sets: Sequence[dict]) -> tuple[list[dict], list[tuple[int, int]]]:
    """Distinct boosters of ``sets`` (n_estimators: the most of theirs), and each set's booster and number of trees."""
    found: dict[str, int] = {}
    out, where = [], []
    for s in sets:
        p = checked(s)
        key = json.dumps({k: v for k, v in p.items() if k != "n_estimators"}, sort_keys=True)
        if key not in found:
            found[key] = len(out)
            out.append(dict(p, n_estimators=0))
        own = out[found[key]]
        own["n_estimators"] = max(own["n_estimators"], p["n_estimators"])
        where.append((found[key], p["n_estimators"]))
    return out, where


def row_number(df: DataFrame, columns: Sequence[str]) -> Column:
    """A number of the row that does not depend on where it is: a hash of ``columns``."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in columns))


def binned(df: DataFrame, features: Sequence[str], label: str, edges, rows: Sequence[str]) -> DataFrame:
    """``_row, _y, _bins`` (a byte a feature); rows without a label go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.column_stack([b.column(f"_{j}").to_numpy(zero_copy_only=False).astype(float) for j in range(len(edges))])
            cells = to_bins(values, edges)
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("_y"), pa.array([r.tobytes() for r in cells], pa.binary())],
                                             names=["_row", "_y", "_bins"])

    own = df.filter(F.col(f"`{label}`").isNotNull()).select(
        row_number(df, rows).alias("_row"), F.col(f"`{label}`").cast("double").alias("_y"),
        *(F.col(f"`{c}`").cast("double").alias(f"_{j}") for j, c in enumerate(features)))
    return own.mapInArrow(run, "_row long, _y double, _bins binary")


def _unpack(column: pa.Array, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, features)


FITTED = "booster int, base double, trees string"


def _fit_here(rows: DataFrame, params: list[dict], base: float, features: int, size: int) -> DataFrame:
    """Every task grows whole boosters over the broadcast rows (their size is checked by the caller)."""
    spark = rows.sparkSession
    got = rows.orderBy("_row").toArrow()
    shared = spark.sparkContext.broadcast((_unpack(got.column("_bins").combine_chunks(), features), got.column("_y").to_numpy(),
                                           got.column("_row").to_numpy()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, y, numbers = shared.value
        for pdf in batches:
            for b, p in zip(pdf["booster"], pdf["params"]):
                trees = grow(bins, y, numbers, base, json.loads(p), size)
                yield pd.DataFrame([(b, base, json.dumps([t.packed() for t in trees]))], columns=["booster", "base", "trees"])

    tasks = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(params)], "booster int, params string")
    return tasks.repartitionByRange(len(params), "booster").mapInPandas(run, FITTED)


def _fit_spread(rows: DataFrame, params: list[dict], base: float, features: int, size: int, keep: int) -> DataFrame:
    """All boosters in step: a pass over the rows for each level, the rows' predictions written every ``keep`` trees."""
    spark = rows.sparkSession
    state = rows.withColumn("_pred", F.lit(None).cast("binary"))
    done: list[list[Tree]] = [[] for _ in params]
    stored = 0

    def pred_of(batch: pa.RecordBatch, bins: np.ndarray, recent: list[list[Tree]]) -> np.ndarray:
        """Rows x boosters: what was written, and the trees since."""
        blob = batch.column("_pred")
        out = np.full((len(bins), len(params)), base) if blob.null_count else \
            np.frombuffer(b"".join(blob.to_pylist()), float).reshape(len(bins), -1).copy()
        for s, trees in enumerate(recent):
            for tree in trees:
                out[:, s] += tree.predict(bins)
        return out

    def level_pass(trees: list[Tree | None], recent, t: int, level: int) -> dict[int, list[tuple]]:
        live = [s for s, tree in enumerate(trees) if tree is not None and tree.open]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                if not b.num_rows:
                    continue
                bins, y, numbers = _unpack(b.column("_bins"), features), b.column("_y").to_numpy(), b.column("_row").to_numpy()
                pred = pred_of(b, bins, recent)
                for s in live:
                    own = histogram(bins, trees[s].nodes(bins, level), trees[s].open, pred[:, s] - y, sampled(numbers, params[s], t), size)
                    sums[s] = sums[s] + own if s in sums else own
            salt = TaskContext.get().partitionId() % 64
            for s, h in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([salt], pa.int32()), pa.array([h.tobytes()], pa.binary())],
                                                 names=["booster", "salt", "hist"])

        def merge(group: pa.Table) -> pa.Table:
            whole = sum(np.frombuffer(x, float) for x in group.column("hist").to_pylist())
            return pa.table({"booster": group.column("booster")[:1], "salt": group.column("salt")[:1], "hist": pa.array([whole.tobytes()], pa.binary())})

        def choose(group: pa.Table) -> pa.Table:
            s = group.column("booster")[0].as_py()
            shape = (2, len(trees[s].open), features, size)
            whole = sum(np.frombuffer(x, float).reshape(shape) for x in group.column("hist").to_pylist())
            splits = best_splits(whole, tree_columns(params[s], t, features), params[s])
            return pa.table({"booster": pa.array([s], pa.int32()), "splits": [json.dumps(splits)]})

        # in two steps, so that no group holds the histograms of all tasks; then a split for each open node
        kind = "booster int, salt int, hist binary"
        found = (state.mapInArrow(add, kind).groupBy("booster", "salt").applyInArrow(merge, kind).groupBy("booster")
                 .applyInArrow(choose, "booster int, splits string").collect())
        return {r["booster"]: json.loads(r["splits"]) for r in found}

    for t in range(max(p["n_estimators"] for p in params)):
        trees = [Tree(p["max_depth"]) if t < p["n_estimators"] else None for p in params]
        recent = [own[stored:] for own in done]
        for level in range(max(p["max_depth"] for p in params)):
            if not any(tree is not None and tree.open and level < tree.depth for tree in trees):
                break
            for tree in trees:
                if tree is not None and level >= tree.depth:
                    tree.open = []
            for s, splits in level_pass(trees, recent, t, level).items():
                apply_splits(trees[s], splits, params[s])
        for s, tree in enumerate(trees):
            if tree is not None:
                tree.prune(params[s]["gamma"])
                done[s].append(tree)
        if (t + 1) % keep == 0:
            recent = [own[stored:] for own in done]

            def write(batches: Iterator[pa.RecordBatch], recent=recent) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    pred = pred_of(b, _unpack(b.column("_bins"), features), recent) if b.num_rows else np.zeros((0, 1))
                    yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("_y"), b.column("_bins"),
                                                      pa.array([r.tobytes() for r in pred], pa.binary())], names=["_row", "_y", "_bins", "_pred"])

            state = _written(state.mapInArrow(write, "_row long, _y double, _bins binary, _pred binary"), "tree-state")
            stored = t + 1
    return spark.createDataFrame([(s, base, json.dumps([x.packed() for x in own])) for s, own in enumerate(done)], FITTED)


def _written(df: DataFrame, name: str) -> DataFrame:
    """A written copy below the shared checkpoint folder: later passes read it, whatever executors are lost."""
    import uuid
    path = table_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_boosters(train: DataFrame, features: Sequence[str], label: str, params: list[dict], edges, rows: Sequence[str],
                 local_cells: int = LOCAL_CELLS, keep: int = 10) -> DataFrame:
    """One row per booster: ``booster, base, trees`` (JSON). ``rows`` are the columns that tell rows apart for sampling."""
    size = max(len(e) for e in edges) + 2
    data = _written(binned(train, features, label, edges, rows), "tree-rows")
    n, base = data.agg(F.count(F.lit(1)), F.avg("_y")).first()
    if not n:
        raise ValueError("no training row has a label")
    here = n * (len(features) + 16) <= local_cells
    return (_fit_here(data, params, base, len(features), size) if here
            else _fit_spread(data, params, base, len(features), size, keep))


def score_boosters(rows: DataFrame, features: Sequence[str], label: str, fitted: DataFrame, where: Sequence[tuple[int, int]], edges) -> DataFrame:
    """``idx, n, sse, sy, syy`` of every set (its booster and number of trees in ``where``) over ``rows``, in one
    pass: the models are sent to the tasks (their size is that of the grid), sums are added map-side."""
    models = {r["booster"]: (r["base"], r["trees"]) for r in fitted.collect()}
    shared = rows.sparkSession.sparkContext.broadcast(models)
    k = len(edges)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = {b: (base, [Tree.unpacked(t) for t in json.loads(trees)]) for b, (base, trees) in shared.value.items()}
        sums = np.zeros((len(where), 4))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y = _unpack(batch.column("_bins"), k), batch.column("_y").to_numpy()
            for b, (base, trees) in loaded.items():
                own = predictions(trees, bins, base, {n for o, n in where if o == b})
                for i, (o, n) in enumerate(where):
                    if o == b:
                        e = y - own[n]
                        sums[i] += (len(y), e @ e, y.sum(), y @ y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(where)), pa.int64()), *(pa.array(c) for c in sums.T)],
                                         names=["idx", "n", "sse", "sy", "syy"])

    data = binned(rows, features, label, edges, [label])
    return (data.mapInArrow(add, "idx long, n double, sse double, sy double, syy double").groupBy("idx")
            .agg(*(F.sum(c).alias(c) for c in ("n", "sse", "sy", "syy"))))


def search_trees(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, sets: Sequence[dict], rows: Sequence[str] | None = None,
                 bins: int = BINS, local_cells: int = LOCAL_CELLS, keep: int = 10) -> DataFrame:
    """``idx, val_r2`` of every parameter set, fitted on ``train`` and scored on ``val`` (null where all labels are equal)."""
    params, where = boosters(sets)
    edges = bin_edges(train, features, bins)
    fitted = _written(fit_boosters(train, features, label, params, edges, rows or [*features, label], local_cells, keep), "tree-models")
    sums = score_boosters(val, features, label, fitted, where, edges)
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return sums.select("idx", F.when((F.col("n") > 0) & (sst > 0), 1 - F.col("sse") / sst).alias("val_r2"))


def predictor(model: dict):
    """A column function for a stored booster (``edges``, ``base``, ``trees``): Arrow batches of the features in, predictions out."""
    @F.pandas_udf("double")
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = [Tree.unpacked(t) for t in model["trees"]]
        for columns in batches:
            bins = to_bins(np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns]), model["edges"])
            yield pd.Series(model["base"] + sum((t.predict(bins) for t in trees), np.zeros(len(bins))))

    return predict


def fit_trees(train: DataFrame, features: Sequence[str], label: str, params: dict, rows: Sequence[str] | None = None, bins: int = BINS,
              local_cells: int = LOCAL_CELLS) -> dict:
    """One booster as a storable dict."""
    edges = bin_edges(train, features, bins)
    got = fit_boosters(train, features, label, [checked(params)], edges, rows or [*features, label], local_cells).first()
    return {"edges": edges, "base": got["base"], "trees": json.loads(got["trees"])}
