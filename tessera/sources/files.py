"""Scans and sinks: CSV with a written row index, SQL over stored tables,
list columns as text, table overwrite, key/value upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import nan_to_null


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             index_col: bool = True) -> DataFrame:
    """SRC-01: header CSV; the first (unnamed) column is a written row index and is
    dropped at scan; NaN becomes NULL. Pass a schema on large inputs (no inference pass)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    if index_col and df.columns:
        df = df.drop(df.columns[0])
    return nan_to_null(df)


def scan_table_sql(spark: SparkSession, query: str) -> DataFrame:
    """SRC-02: SQL text over registered tables / views."""
    return spark.sql(query)


def decode_list_columns(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """SRC-03: Python list text (``['a', "b"]``) back to arrays; ``cols`` maps a column
    to its element type. Values that are not text pass unchanged."""
    out = {}
    for c, elem in cols.items():
        if isinstance(df.schema[c].dataType, T.StringType):
            out[c] = F.from_json(F.col(c), f"array<{elem}>", {"allowSingleQuotes": "true",
                                                             "allowNonNumericNumbers": "true"})
    return df.withColumns(out)


def encode_list_columns(df: DataFrame) -> DataFrame:
    """SRC-04: array / map / struct columns to JSON text for text sinks."""
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.withColumns({c: F.to_json(F.col(c)) for c in nested})


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """SNK-01: replace the table at ``path`` (no index column)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def sink_csv(df: DataFrame, path: str, index: str | None = None) -> str:
    """SNK-02: header CSV (nested columns as JSON text); optional leading index column."""
    out = encode_list_columns(df)
    if index:
        out = out.select(F.col(index).alias("_c0"), *[c for c in out.columns if c != index])
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def bootstrap_tables(spark: SparkSession, ticker_csv: str, news_csv: str, out_dir: str,
                     ticker_schema=None, news_schema=None) -> dict[str, str]:
    """SRC-05: load the two CSVs, project news to (date, mean_sentiment_score), store both."""
    ticker = scan_csv(spark, ticker_csv, ticker_schema)
    news = scan_csv(spark, news_csv, news_schema).select("date", "mean_sentiment_score")
    return {"ticker_data": overwrite_table(ticker, f"{out_dir}/ticker_data"),
            "news_data": overwrite_table(news, f"{out_dir}/news_data")}


def metric_doc(record: DataFrame, path: str) -> str:
    """SNK-03: append a nested run record (one row of structs) as JSON."""
    record.write.mode("append").json(path)
    return path


def kv_upsert(existing: DataFrame | None, new: DataFrame, key: str = "name", value: str = "value") -> DataFrame:
    """SNK-04: keys of both; the new value wins; values as double."""
    new = new.select(key, F.col(value).cast("double").alias("__new"))
    if existing is None:
        return new.select(key, F.col("__new").alias(value))
    old = existing.select(key, F.col(value).cast("double").alias("__old"))
    return old.join(new, key, "full").select(key, F.coalesce("__new", "__old").alias(value))
