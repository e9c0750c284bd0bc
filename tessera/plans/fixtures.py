"""Inputs of the reference's shape derived from the driver's tables.

* price panel: ``events`` per hour and ``event_type``, the cell value is the latest
  ``value`` of the hour; ``purchase`` plays the main price.
* long daily series: ``orders`` total price per order day.
* news: ``documents`` dated ``2024-01-01 + doc_id % 30`` days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import date_spine
from ..operators.panel import spine_left_join
from .registry import table

# The five event types of the test table, in name order.
SERIES = ["click", "error", "purchase", "signup", "view"]
MAIN = "purchase"
NEWS_EPOCH = "2024-01-01"
NEWS_DAYS = 30


def hourly_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.date_trunc("hour", F.col("ts")).alias("hour"), "event_type", "value", "ts")


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide hourly panel on a full hourly spine (null where a series had no event)."""
    cells = hourly_cells(spark, sf_dir)
    spine = date_spine(cells, "hour", "1 hour")
    return spine_left_join(spine, cells, "hour", "event_type", "value", SERIES, pick="ts")


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("value")))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.date_add(F.lit(NEWS_EPOCH).cast("date"), (F.col("doc_id") % NEWS_DAYS).cast("int")).alias("date"),
                    "doc_id", "text", "lang")


# DuckDB text of the same derived inputs, shared by the oracle queries.
SQL_HOURLY_PANEL = """
cells AS (SELECT date_trunc('hour', ts) AS hour, event_type, value, ts FROM events),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour
          FROM (SELECT min(hour) AS lo, max(hour) AS hi FROM cells)),
wide AS (SELECT hour,
    arg_max(value, ts) FILTER (WHERE event_type = 'click') AS click,
    arg_max(value, ts) FILTER (WHERE event_type = 'error') AS error,
    arg_max(value, ts) FILTER (WHERE event_type = 'purchase') AS purchase,
    arg_max(value, ts) FILTER (WHERE event_type = 'signup') AS signup,
    arg_max(value, ts) FILTER (WHERE event_type = 'view') AS view
  FROM cells GROUP BY hour),
panel AS (SELECT s.hour, w.click, w.error, w.purchase, w.signup, w.view
          FROM spine s LEFT JOIN wide w ON s.hour = w.hour)
"""

SQL_DAILY_ORDERS = """
daily AS (SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date, round(sum(o_totalprice), 2) AS value
          FROM orders GROUP BY 1)
"""

SQL_NEWS = """
news AS (SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP) AS date,
                doc_id, text, lang FROM documents)
"""
