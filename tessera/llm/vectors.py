"""Near duplicates among embeddings: random-hyperplane signs in several tables, exact cosines, and
distributed connected components.

Vectors that are equal in every component and in label are one class; only classes are hashed and
compared. A table's bucket holds the classes of a label with equal signs. A bucket is compared
in blocks of bounded size, with one matrix product a block; out of a block come each class's
number of links and a spanning forest of the links, never all pairs. A pair that meets in several
tables counts in the first of them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import components


def tables_for(bits: int, threshold: float, recall: float) -> int:
    """Tables needed so that a pair at the threshold meets with probability ``recall`` in one of them."""
    together = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return 1 if together >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def hyperplanes(count: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).normal(size=(count, dims))


def block_links(vectors: np.ndarray, codes: np.ndarray, sides: np.ndarray, weights: np.ndarray, table: int,
                threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of a block: each row's weighted number of partners, and its place in a spanning forest.

    ``sides`` tells the two chunks of a block apart; with ``same`` all rows are one chunk. Pairs whose
    codes agree in a table before ``table`` are left to that table."""
    size = len(vectors)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    left, right = (np.arange(size),) * 2 if same else (np.flatnonzero(~sides), np.flatnonzero(sides))
    close = vectors[left] @ vectors[right].T
    close /= norms[left][:, None]
    close /= norms[right][None, :]
    i, j = np.nonzero(close >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    i, j = left[i], right[j]
    for t in range(table):
        new = codes[i, t] != codes[j, t]
        i, j = i[new], j[new]
    partners = np.bincount(i, weights[j], size) + np.bincount(j, weights[i], size)
    root = np.arange(size)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
    return partners, root


def link_vectors(vectors: DataFrame, threshold: float = 0.98, recall: float = 0.995, bucket: int = 128,
                 chunk: int = 2048, seed: int = 23, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str | None = "label") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Two rows link if their labels are equal and not null (any two rows if ``label_col`` is None)
    and their cosine in double precision is at least ``threshold``. Vectors that are null, empty,
    zero, or hold a null or non-finite component, and rows with a null label, link with nothing
    and are their own component. Vectors of different lengths never link. Repeated ids stay
    rows of their own. The number of sign bits follows the number of classes (buckets of about
    ``bucket``), and the tables the bits, so that a pair at the threshold is found with
    probability ``recall`` whatever the size; nearer pairs are found more surely.
    An empty table gives an empty result."""
    label = F.lit(0) if label_col is None else F.col(label_col)
    double = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    inf = float("inf")
    good = F.coalesce(
        F.col("_label").isNotNull() & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
        & F.exists("_v", lambda x: x != 0), F.lit(False))
    # equal to the last bit: the components' text would lose it, so two hashes of the array (0.0 for -0.0)
    exact = F.transform("_v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("_label"), double.alias("_v"))
            .withColumn("_v", F.when(good, exact))
            .withColumn("_k1", F.when(F.col("_v").isNotNull(), F.xxhash64("_label", "_v")))
            .withColumn("_k2", F.when(F.col("_v").isNotNull(), F.xxhash64(F.lit(seed), "_v", "_label"))))
    classes = materialize(
        rows.where(F.col("_v").isNotNull()).groupBy("_k1", "_k2", "_label")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("_v").alias("v")), "vector-classes")
    crowd = classes.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(62, max(6, math.ceil(math.log2(max(1.0, crowd / bucket)))))
    count = tables_for(bits, threshold, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            values = batch.column("v")
            flat = values.flatten().to_numpy(zero_copy_only=False)
            cuts = values.offsets.to_numpy() - values.offsets[0].as_py()
            codes = np.zeros((batch.num_rows, count), np.int64)
            sizes = np.diff(cuts)
            for dims in np.unique(sizes):
                own = np.flatnonzero(sizes == dims)
                at = cuts[own][:, None] + np.arange(dims)
                planes = hyperplanes(bits * count, int(dims), seed)
                codes[own] = ((flat[at] @ planes.T) > 0).reshape(len(own), count, bits) @ power
            packed = [flat[a:b].astype("<f8").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("n"), batch.column("lab"), pa.array(packed, pa.binary()),
                 pa.array(list(codes), pa.list_(pa.int64()))], names=["rep", "n", "lab", "v", "codes"])

    signed = classes.select("rep", "n", F.xxhash64("_label", F.size("v")).alias("lab"), "v") \
        .mapInArrow(sign, "rep long, n long, lab long, v binary, codes array<long>")
    signed = materialize(signed, "vector-signs")
    where = F.posexplode("codes").alias("t", "code")
    crowded = (signed.select("lab", where).groupBy("t", "lab", "code").agg(F.count(F.lit(1)).alias("m"))
               .where(F.col("m") > 1).select("t", "lab", "code", F.ceil(F.col("m") / chunk).cast("int").alias("chunks")))
    own = F.pmod(F.xxhash64(F.lit(seed + 1), "rep"), F.col("chunks")).cast("int")
    blocks = (signed.select("rep", "n", "lab", "v", "codes", where).join(crowded, ["t", "lab", "code"])
              .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .withColumn("c1", F.least("own", "other")).withColumn("c2", F.greatest("own", "other"))
              .select("t", "lab", "code", "c1", "c2", "own", "rep", "n", "v", "codes"))
    key = ["t", "lab", "code", "c1", "c2"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, key):
            t, c1, c2 = (group.column(k)[0].as_py() for k in ("t", "c1", "c2"))
            rep = group.column("rep").to_numpy()
            if len(rep) < 2:
                continue
            data = np.stack([np.frombuffer(x, "<f8") for x in group.column("v").to_pylist()])
            codes = np.stack(group.column("codes").to_pylist())
            partners, root = block_links(data, codes, group.column("own").to_numpy() == c2, group.column("n").to_numpy(),
                                         t, threshold, c1 == c2)
            some = partners > 0
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[some]), pa.array(partners[some].astype(np.int64)), pa.array(rep[root[some]])],
                    names=["rep", "links", "root"])

    found = materialize(blocks.repartition(*key).sortWithinPartitions(*key)
                        .mapInArrow(compare, "rep long, links long, root long"), "vector-links")
    joined = components(found, "rep", "root")
    per_class = (classes.select("_k1", "_k2", "rep", "n")
                 .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
                 .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("_k1", "_k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    return (rows.select("vec_id", "_k1", "_k2").join(per_class, ["_k1", "_k2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, also across batches. Holds one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).cast(pa.int64()).to_numpy() for k in key], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            now = tuple(keys[a])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
