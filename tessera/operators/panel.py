"""Joins, aggregations, set operations, sorts and limits over panel tables
(SURVEY 2.3, 2.4, 2.6, 2.7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ordered as O


# ------------------------------------------------------------------ joins

def pivot_series(long: DataFrame, on: str, series: str, value: str, names: Sequence[str],
                 pick: str | None = None) -> DataFrame:
    """Long ``(on, series, value)`` to wide, one column per name, in one shuffle.
    Several values in a cell: the one with the largest ``pick`` (else the max)."""
    agg = F.max_by(value, pick) if pick else F.max(value)
    return long.groupBy(on).pivot(series, list(names)).agg(agg)


def spine_left_join(spine: DataFrame, long: DataFrame, on: str, series: str, value: str,
                    names: Sequence[str], pick: str | None = None) -> DataFrame:
    """JOI-01: spine left join the instruments, one pivot instead of one join per
    instrument. The pivot has one row per spine value at most, so the join is on a
    unique key on both sides."""
    wide = pivot_series(long, on, series, value, names, pick)
    return spine.join(wide, on, "left")


def sentiment_price_join(news: DataFrame, price: DataFrame, on: str = "date") -> DataFrame:
    """JOI-02: every news row, price columns null on days without trading; repeated
    dates in ``news`` fan out as in the reference."""
    return news.join(price, on, "left")


def semi_join_dates(df: DataFrame, dates: DataFrame, on: str = "date") -> DataFrame:
    """JOI-03: keep rows whose date is in ``dates``."""
    return df.join(dates.select(on), on, "left_semi")


# ------------------------------------------------------------ aggregations

def high_water_mark(df: DataFrame, col: str = "date", as_of=None, default_days: int = 7,
                    name: str = "high_water_mark") -> DataFrame:
    """AGG-01: newest date, or ``as_of - 7 days`` when the table is empty."""
    today = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
    return df.agg(F.coalesce(F.max(F.to_date(F.col(col))), F.date_sub(today, default_days)).alias(name))


def group_collect(df: DataFrame, key: str, value: str, order: Sequence[str],
                  name: str = "items") -> DataFrame:
    """AGG-02: values per key in a fixed order (``order`` breaks ties), as rows ``key, position, name``
    (from 1). A key's values are spread over the buckets of its rows; no list holds them all."""
    rows = df.select(key, *[o for o in order if o != key], F.col(value).alias("__v"))
    return O.positions(rows, [key], list(order)).select(key, F.col(O.POS).alias("position"), F.col("__v").alias(name))


def group_score_mean(df: DataFrame, key: str, text: str, score: str, order: Sequence[str],
                     ) -> tuple[DataFrame, DataFrame]:
    """AGG-03: texts and scores as rows ``key, position, news, sentiment_score``, and per key the
    number of texts ``n_news`` and the null-skipping mean score (both summed map-side)."""
    pair = df.withColumn("__pair", F.struct(F.col(text).alias("news"), F.col(score).alias("sentiment_score")))
    items = group_collect(pair, key, "__pair", order).select(key, "position", "items.news", "items.sentiment_score")
    means = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_news"), F.avg(score).alias("mean_sentiment_score"))
    return items, means


def parts_digest(items: DataFrame, key: str, value: str, name: str, part: int = 1000) -> DataFrame:
    """One md5 per key over its values in order of ``position``: each value's md5 (null: empty), the md5 of ``part`` of them joined, and
    the md5 of the parts' joined. A group holds ``part`` hashes, so a key of any size is spread over tasks."""
    rows = items.select(key, ((F.col("position") - 1) / part).cast("long").alias("__part"), "position",
                        F.coalesce(F.md5(F.col(value).cast("string")), F.lit("")).alias("__h"))

    def joined(order: str, what: str):
        return F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, what))), lambda x: x[what]), ""))

    parts = rows.groupBy(key, "__part").agg(joined("position", "__h").alias("__h"))
    return parts.groupBy(key).agg(joined("__part", "__h").alias(name))


def parts_digest_sql(rows: str, key: str, value: str, order: str, name: str, part: int = 1000) -> str:
    """DuckDB text of ``parts_digest`` over the table ``rows``."""
    return f"""(SELECT {key}, md5(string_agg(m, '' ORDER BY part)) AS {name} FROM (
  SELECT {key}, part, md5(string_agg(h, '' ORDER BY rn)) AS m FROM (
    SELECT {key}, rn, (rn - 1) // {part} AS part, coalesce(md5({value}), '') AS h FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {rows})) GROUP BY ALL) GROUP BY {key})"""


def ordered_digest(items: DataFrame, key: str, value: str, sep: str, name: str) -> DataFrame:
    """md5 per key of the non-null texts ``value`` in order of ``position``, joined by ``sep`` (null where a key has none).

    The sum needs a key's rows one after the other, so a task reads all of a key, but it holds one batch."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, begun = None, None, False

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], kind), pa.array([state.hexdigest() if begun else None], pa.string())], names=[key, name])

        for batch in batches:
            kind = batch.schema.field(key).type
            for k, v in zip(batch.column(key).to_pylist(), batch.column(value)):
                if state is None or k != at:
                    if state is not None:
                        yield out()
                    at, state, begun = k, hashlib.md5(), False
                if v.is_valid:
                    state.update(((sep if begun else "") + v.as_py()).encode())
                    begun = True
        if state is not None:
            yield out()

    kind_of = items.schema[key].dataType.simpleString()
    return (items.select(key, "position", value).repartition(key).sortWithinPartitions(key, "position").select(key, value)
            .mapInArrow(digest, f"`{key}` {kind_of}, `{name}` string"))


def quantiles(df: DataFrame, cols: Sequence[str], probs=(0.25, 0.75)) -> DataFrame:
    """AGG-06: exact linear-interpolated quantiles, one row, ``<c>_q<p*100>`` columns
    (rank selection by narrowing bands; no column is gathered into one task)."""
    from .quantiles import exact_quantiles
    q = exact_quantiles(df, cols, probs)
    names = [f"{c}_q{int(round(p * 100))}" for c in cols for p in probs]
    vals = [q[(c, p)] for c in cols for p in probs]
    return df.sparkSession.createDataFrame([tuple(vals)], ", ".join(f"`{n}` double" for n in names))


def distinct_rows(df: DataFrame) -> DataFrame:
    """AGG-11."""
    return df.dropDuplicates()


def _comparable(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns that can break a tie: all that have an order."""
    def ordered(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(ordered(f.dataType) for f in kind.fields)
        return ordered(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))
    return [c for c in cols if ordered(df.schema[c].dataType)]


def dedupe_keep_last(df: DataFrame, key: Sequence[str] | str, ingest_order: Sequence[str] | str
                     ) -> DataFrame:
    """AGG-12: one row per key, the latest by ingest order wins; of rows with equal order the one that is
    largest in its other columns. A ``max_by`` aggregate, so a hot key is reduced map-side instead of being sorted in one task."""
    key = [key] if isinstance(key, str) else list(key)
    io = [ingest_order] if isinstance(ingest_order, str) else list(ingest_order)
    rest = [c for c in df.columns if c not in key]
    tie = _comparable(df, [c for c in rest if c not in io])
    packed = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*io, *tie)).alias("__r"))
    return packed.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def argmax_params(results: DataFrame, score: str, idx: str, group: Sequence[str] = (),
                  cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-13: best row by ``score``; on ties the smallest ``idx`` (first tried) wins; a NaN score is no score."""
    cols = cols or [c for c in results.columns if c not in group]
    best = results.groupBy(*group).agg(
        F.max_by(F.struct(*cols), F.struct(F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")), -F.col(idx))).alias("__b"))
    return best.select(*group, *[F.col(f"__b.{c}").alias(c) for c in cols])


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """AGG-10."""
    return df.agg(F.count(F.lit(1)).alias(name))


# ---------------------------------------------------------- set operations

def union_all(*dfs: DataFrame) -> DataFrame:
    """SET-01: by name, missing columns become null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def combine_splits(df: DataFrame, col: str = "split", parts=("train", "val")) -> DataFrame:
    """SET-02."""
    return df.filter(F.col(col).isin(list(parts)))


def incremental_upsert(existing: DataFrame, new: DataFrame, date: str = "date",
                       main: str = "nsei", batch: str = "__batch", pos: str = "__pos_in",
                       digits: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """SET-03: existing + new rows; rows without the main price dropped; back-fill in
    input order; last row per date wins; numbers rounded half-to-even.

    Input order is (batch, position): the caller stamps each batch (existing first).
    """
    from ..functions.numeric import round_half_even
    keys = list(keys)
    both = union_all(existing, new)
    both = both.na.drop(subset=[main])
    value_cols = [c for c in both.columns if c not in keys + [date, batch, pos]]
    bucket = F.struct(F.col(batch), O.row_buckets(both, pos).alias("part"))
    filled = O.backfill(both, value_cols, keys=keys, order=[batch, pos], bucket=bucket)
    latest = dedupe_keep_last(filled, keys + [date], [batch, pos])
    num = [f.name for f in latest.schema.fields
           if f.name in value_cols and f.dataType.typeName() in ("double", "float")]
    return latest.withColumns({c: round_half_even(F.col(c), digits) for c in num})


def news_append(existing: DataFrame, new: DataFrame, dedupe_on: Sequence[str] | None = None
                ) -> DataFrame:
    """SET-04: append, no dedupe unless asked."""
    out = union_all(existing, new)
    return out.dropDuplicates(list(dedupe_on)) if dedupe_on else out


def column_set_diff(spark, required: Sequence[str], present: Sequence[str], name="column"
                    ) -> DataFrame:
    """SET-05 on schemas (driver-side metadata, not row data)."""
    missing = [c for c in required if c not in set(present)]
    return spark.createDataFrame([(c,) for c in missing], f"{name} string")


# ------------------------------------------------------------- sort / limit

def sort_by(df: DataFrame, cols: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """SRT-01: ascending with an explicit tie key."""
    return df.orderBy(*[F.col(c).asc() for c in list(cols) + list(tie)])


def rank_models(report: DataFrame, score: str = "test_adj_r2", name: str = "model") -> DataFrame:
    """SRT-02: descending score, missing, NaN and exactly 0 last."""
    eff = F.when((F.col(score) == 0) | F.isnan(score), None).otherwise(F.col(score))
    return report.withColumn("__s", eff).orderBy(F.col("__s").desc_nulls_last(), F.col(name)).drop("__s")


def last_row(df: DataFrame, order: Sequence[str] | str, keys: Sequence[str] = ()) -> DataFrame:
    """LIM-01: the last row (per key) as a ``max_by`` aggregate, no global sort; of rows with equal order the
    one that is largest in its other columns."""
    order = [order] if isinstance(order, str) else list(order)
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order, *_comparable(df, [c for c in rest if c not in order]))).alias("__r")
    r = df.groupBy(*keys).agg(last) if keys else df.agg(last).filter(F.col("__r").isNotNull())
    return r.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def all_but_last(df: DataFrame, target: str = "target") -> DataFrame:
    """LIM-02: rows with a target (the last row has none)."""
    return df.filter(F.col(target).isNotNull())


def first_entry(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """LIM-03."""
    return df.orderBy(*order).limit(1)


def head_tail(df: DataFrame, order: Sequence[str], n: int = 5, tail: bool = False) -> DataFrame:
    """LIM-04: first or last ``n`` rows in order (top-k, no full sort)."""
    cols = [F.col(c).desc() if tail else F.col(c).asc() for c in order]
    return df.orderBy(*cols).limit(n)
