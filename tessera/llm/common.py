"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder and read it back.

    This cuts the lineage: what was computed survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], column: str, target: int) -> Iterator[pa.RecordBatch]:
    """Re-cut Arrow batches so that ``column`` holds about ``target`` bytes in each
    (a single longer value stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
                         .astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + target, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


#: empties what an operator keeps in a Python worker from task to task
RELEASE: list[Callable[[], None]] = []


def release(keep: bool = False) -> None:
    """Empties what other operators keep in this reused worker (unless ``keep``), and gives freed
    memory back to the system (glibc holds it otherwise)."""
    for empty in () if keep else RELEASE:
        empty()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(run: Callable[[Iterator], Iterator], keep: bool = False) -> Callable[[Iterator], Iterator]:
    """A batch function that releases memory at its start and end."""
    def wrapped(batches: Iterator) -> Iterator:
        release(keep)
        try:
            yield from run(batches)
        finally:
            release(keep)
    return wrapped


def clean_text(col: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold(doc_id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts`` (null ids fall in fold 0)."""
    return F.coalesce(F.crc32(F.col(doc_id_col).cast("string")) % parts, F.lit(0)).cast("int")


def stretch(text_col: str, longest: int):
    """A text of at most ``longest`` code points whole; of a longer one so many, from a place hashed from it."""
    text = F.col(text_col)
    at = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - longest + 1, F.lit(1)))
    return F.when(F.length(text) <= longest, text).otherwise(F.substring(text, (at + 1).cast("int"), F.lit(longest)))


#: steps of the hash threshold
STEPS = 1 << 40


def below(hash_col: str, share: float):
    """Whether a hash lies in the lowest ``share`` of its range."""
    return F.pmod(F.col(hash_col), F.lit(STEPS)) < F.lit(int(share * STEPS))


def hash_shares(rows: DataFrame, group_col: str, budget: int, max_rows: int) -> dict:
    """For each group of ``rows`` (with ``_size``, their code points) the share of rows that holds about ``budget`` code points
    and a fifth more than ``max_rows`` rows at most. One number a group comes to the driver."""
    sizes = rows.groupBy(group_col).agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    return {r[group_col]: min(1.0, budget / max(r["size"], 1), 1.2 * max_rows / r["n"] + 100 / r["n"]) for r in sizes}


def one_text_ids(docs: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, DataFrame] | None:
    """Where an id has rows with different texts: ``docs`` with a number ``name`` for each (id, text), which ascends with the id (null
    for a null id), and the table ``name, id``. None where ids tell texts apart. Only ids and hashes of texts are shuffled to find out."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("_hash")).where("_id is not null")
    if not rows.groupBy("_id").agg((F.min("_hash") != F.max("_hash")).alias("many")).where("many").limit(1).count():
        return None
    ranged = rows.distinct().repartitionByRange("_id", "_hash").sortWithinPartitions("_id", "_hash")
    numbers = materialize(ranged.withColumn(name, F.monotonically_increasing_id()), "text-ids")
    own = docs.withColumns({"_own": F.col(id_col).cast("long"), "_text_hash": F.coalesce(F.xxhash64(text_col), F.lit(0))})
    numbered = own.join(numbers, (F.col("_own") == F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left") \
        .select(*(own[c] for c in docs.columns), name)
    return materialize(numbered, "text-id-docs"), numbers.select(name, F.col("_id").alias("id"))
