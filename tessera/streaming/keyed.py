"""Incremental ingest with state per key.

STR-01: each key keeps its high-water mark and its last value in the stream's own state. A micro-batch lets through the days behind
the mark and before ``as_of`` (the day's last row by ``order``), each with the value of the day before it, and moves the mark. Rows
of a day that was let through, and late ones, are ignored, in whatever batch they come. Nothing stored is read again.

STR-02: per day the sums of the scores; a micro-batch tells the days that it changed.

Both write the rows of an epoch into the epoch's own folder of the target. A replayed epoch writes the same folder again, so it
is there once, and no batch rewrites what others wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .ingest import _exists

EPOCH = "epoch"
#: the epoch of rows that were there before the stream
HISTORY = -1


def _write_epoch(rows: DataFrame, target: str, epoch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{target}/{EPOCH}={epoch}")


def read_target(spark: SparkSession, target: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all epochs, with their epoch."""
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) if isinstance(schema, T.StructType) else schema
    if not _exists(spark, target):
        return spark.createDataFrame([], f"{own}, {EPOCH} int")
    return spark.read.schema(f"{own}, {EPOCH} int").parquet(target)


def _columns(schema: T.StructType, keys: Sequence[str], date: str, value: str) -> T.StructType:
    return T.StructType([*(schema[k] for k in keys), T.StructField(date, T.DateType()), T.StructField(value, T.DoubleType()),
                         T.StructField(f"prev_{value}", T.DoubleType())])


def write_history(history: DataFrame, target: str, keys: Sequence[str], date: str, value: str) -> None:
    """Stores rows that were there before the stream; the stream goes on behind them."""
    kinds = _columns(history.schema, keys, date, value)
    _write_epoch(history.withColumn(f"prev_{value}", F.lit(None).cast("double")).select(*(F.col(f.name).cast(f.dataType) for f in kinds)),
                 target, HISTORY)


def new_days(stream: DataFrame, marks: DataFrame | None, keys: Sequence[str], date: str, value: str, order: str, as_of: dt.date) -> DataFrame:
    """The days behind each key's mark (see the module). ``marks``: keys, ``mark`` and ``last`` to begin with."""
    keys = list(keys)
    kinds = _columns(stream.schema, keys, date, value)
    rows = stream.select(*keys, F.to_date(date).alias(date), F.col(value).cast("double").alias(value), F.col(order).alias("__order"))
    rows = rows.filter(F.col(date).isNotNull() & (F.col(date) < F.lit(as_of)))
    if marks is None:
        rows = rows.withColumns({"__mark": F.lit(None).cast("date"), "__last": F.lit(None).cast("double")})
    else:
        known = marks.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("mark").alias("__mark"), F.col("last").alias("__last"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        rows = rows.join(known, same, "left").drop(*(f"__k{i}" for i in range(len(keys))))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark, last = state.get if state.exists else (None, None)
        begun = state.exists
        best: dict[dt.date, tuple] = {}  # a row a day
        for pdf in batches:
            if not begun and len(pdf):
                begun = True
                m, v = pdf["__mark"].iloc[0], pdf["__last"].iloc[0]
                mark, last = (None if pd.isna(m) else m), (None if pd.isna(v) else float(v))
            for day, v, o in zip(pdf[date], pdf[value], pdf["__order"]):
                if (mark is None or day > mark) and (day not in best or o >= best[day][0]):
                    best[day] = (o, None if pd.isna(v) else float(v))
        out = []
        for day in sorted(best):
            out.append((*key, day, best[day][1], last))
            mark, last = day, best[day][1]
        state.update((mark, last))
        yield pd.DataFrame(out, columns=kinds.names)

    # without a key, all rows belong to one series
    grouped = rows.groupBy(*keys) if keys else rows.withColumn("__all", F.lit(0)).groupBy("__all")
    own = step if keys else (lambda key, batches, state: step((), batches, state))
    return grouped.applyInPandasWithState(own, kinds, "mark date, last double", "update", GroupStateTimeout.NoTimeout)


def _run(query, target: str, checkpoint: str) -> None:
    def put(batch: DataFrame, epoch: int) -> None:
        _write_epoch(batch, target, epoch)

    started = query.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).start()
    try:
        started.processAllAvailable()
    finally:
        started.stop()


def ingest_days(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], date: str, value: str, order: str,
                as_of: dt.date) -> DataFrame:
    """STR-01: takes all that the stream holds now and returns the target: keys, date, value and the value of the key's day before
    (null for rows of the history). Call it again with the same folders to go on."""
    spark = stream.sparkSession
    kinds = _columns(stream.schema, list(keys), date, value)
    marks = None
    if _exists(spark, f"{target}/{EPOCH}={HISTORY}"):
        old = spark.read.schema(kinds).parquet(f"{target}/{EPOCH}={HISTORY}")
        marks = old.groupBy(*keys).agg(F.max(date).alias("mark"), F.max_by(value, date).alias("last"))
    _run(new_days(stream, marks, keys, date, value, order, as_of), target, checkpoint)
    return read_target(spark, target, kinds).drop(EPOCH)


def daily_scores(stream: DataFrame, target: str, checkpoint: str, ts: str = "ts", score: str = "score", watermark: str = "1 day") -> DataFrame:
    """STR-02: takes all that the stream holds now and returns ``date, mean_score, n``: of each day the newest row told. Null scores
    count in neither. Rows later than the watermark are left out by Spark."""
    spark = stream.sparkSession
    kinds = "date date, mean_score double, n long"
    days = (stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark).groupBy(F.window(ts, "1 day").alias("w"))
            .agg(F.avg(score).alias("mean_score"), F.count(score).alias("n"))
            .select(F.to_date(F.col("w.start")).alias("date"), "mean_score", "n"))
    _run(days, target, checkpoint)
    return (read_target(spark, target, kinds).groupBy("date")
            .agg(F.max_by("mean_score", EPOCH).alias("mean_score"), F.max_by("n", EPOCH).alias("n")))
