"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per operator
key, with the DuckDB text that computes the same table when one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def contract(df: DataFrame) -> DataFrame:
    """Output convention of registered queries: calendar days leave as midnight
    timestamps, the form the driver's tables use for days."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    if not dates:
        return df
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates})


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return contract(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output contract: doubles rounded so float summation order does not show."""
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def ensure_loaded() -> None:
    from . import (  # noqa: F401  (registration side effects)
        column_queries,
        feature_queries,
        io_queries,
        model_queries,
        quality_queries,
        text_queries,
        panel_queries,
    )
