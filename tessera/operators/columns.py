"""Projections, filters, predicates, casts and generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-01."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str] = (), first: bool = False) -> DataFrame:
    """PRJ-02: drop named columns (missing names are ignored) and optionally the first
    column by position (a written row index)."""
    out = df.drop(*cols)
    if first and out.columns:
        out = out.drop(out.columns[0])
    return out


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-03."""
    return df.withColumnsRenamed(mapping)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """PRJ-04: numeric columns by type, minus ``exclude`` (the target)."""
    return df.select(*numeric_columns(df, exclude))


def wide_to_map(df: DataFrame, cols: Sequence[str], name: str = "values") -> DataFrame:
    """PRJ-05: ``{column: value}`` map per row."""
    return df.select(F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                       F.array(*[F.col(c).cast("double") for c in cols])).alias(name))


def date_range_filter(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """FLT-01: ``lo < col <= hi``; without ``lo`` only the upper bound applies."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) > (lo if isinstance(lo, Column) else F.lit(lo)))
    if hi is not None:
        cond = cond & (F.col(col) <= (hi if isinstance(hi, Column) else F.lit(hi)))
    return df.filter(cond)


def drop_null_any(df: DataFrame) -> DataFrame:
    """FLT-02."""
    return df.na.drop("any")


def drop_null_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-03."""
    return df.na.drop(subset=list(cols))


def isin_filter(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """FLT-04: literal list for short lists, semi join for a table of values."""
    if isinstance(values, DataFrame):
        vcol = values.columns[0]
        return df.join(values.select(F.col(vcol).alias(col)).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def keep_truthy(df: DataFrame, col: str) -> DataFrame:
    """FLT-05: drop null / blank results."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.StringType):
        return df.filter(c.isNotNull() & (F.trim(c) != ""))
    return df.filter(c.isNotNull())


def drop_blank_items(arr: Column) -> Column:
    """FLT-05 on arrays: keep items whose trimmed text is not empty."""
    return F.filter(arr, lambda x: F.trim(x) != "")


def any_predicate(df: DataFrame, cond: Column, name: str = "any") -> DataFrame:
    """FLT-06: one row, true when some row satisfies ``cond`` (false on empty input)."""
    return df.agg(F.coalesce(F.bool_or(F.coalesce(cond, F.lit(False))), F.lit(False)).alias(name))


def is_empty(df: DataFrame, name: str = "is_empty") -> DataFrame:
    """FLT-07 as a table (``DataFrame.isEmpty()`` is the driver-side form)."""
    return df.agg((F.count(F.lit(1)) == 0).alias(name))


def null_column(df: DataFrame, name: str, dtype: str = "double") -> DataFrame:
    """GEN-02."""
    return df.withColumn(name, F.lit(None).cast(dtype))


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Scan rule: pandas aggregates skip NaN, Spark's do not; make NaN a SQL NULL."""
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def date_spine(df: DataFrame, col: str, step: str = "1 day", lo=None, hi=None,
               keys: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """GEN-01: every step from ``lo`` to ``hi`` (defaults: min / max of ``col``), per key.
    The spine grows with the calendar range, not with the data; one row per key
    reaches the generator, so keyed spines spread over the keys."""
    name = name or col
    keys = list(keys)
    lo_c = F.lit(lo) if lo is not None and not isinstance(lo, Column) else lo
    hi_c = F.lit(hi) if hi is not None and not isinstance(hi, Column) else hi
    bounds = df.groupBy(*keys).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    lo_e = lo_c if lo_c is not None else F.col("__lo")
    hi_e = hi_c if hi_c is not None else F.col("__hi")
    seq = F.sequence(lo_e, hi_e, F.expr(f"interval {step}"))
    return bounds.select(*keys, F.explode(seq).alias(name))
