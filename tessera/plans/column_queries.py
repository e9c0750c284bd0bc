"""Projections, filters, casts and generators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..operators import columns as C
from .fixtures import SERIES, SQL_DAILY_ORDERS, SQL_HOURLY_PANEL, daily_orders, hourly_panel
from .registry import query, round_doubles, table


@query("project", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_project(spark, sf):
    return C.project(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@query("drop_columns", "SELECT o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def q_drop_columns(spark, sf):
    # first column by position (a written row index) plus named ones, missing names ignored
    return C.drop_columns(table(spark, sf, "orders"), ["o_orderpriority", "no_such_column"], first=True)


@query("rename", "SELECT event_id, ts AS date, event_type AS series, value AS price FROM events")
def q_rename(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return C.rename(ev, {"ts": "date", "event_type": "series", "value": "price"})


@query("select_numeric", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount FROM lineitem""")
def q_select_numeric(spark, sf):
    return C.select_numeric(table(spark, sf, "lineitem"), exclude=["l_tax"])


@query("wide_to_map", f"""WITH {SQL_HOURLY_PANEL}
SELECT hour, name, value FROM (
  UNPIVOT (SELECT hour, {", ".join(SERIES)} FROM panel) ON {", ".join(SERIES)} INTO NAME name VALUE value)""")
def q_wide_to_map(spark, sf):
    p = hourly_panel(spark, sf)
    m = p.select("hour", F.map_from_arrays(F.array(*[F.lit(c) for c in SERIES]),
                                           F.array(*[F.col(c) for c in SERIES])).alias("values"))
    return m.select("hour", F.explode("values").alias("name", "value")).filter(F.col("value").isNotNull())


@query("date_range_filter", f"""WITH {SQL_DAILY_ORDERS}
SELECT date, value FROM daily WHERE date > DATE '1996-01-01' AND date <= DATE '1996-12-31'""")
def q_date_range_filter(spark, sf):
    return C.date_range_filter(daily_orders(spark, sf), "date", F.lit("1996-01-01").cast("date"),
                               F.lit("1996-12-31").cast("date"))


@query("drop_null_any", f"WITH {SQL_HOURLY_PANEL} SELECT * FROM panel WHERE "
       + " AND ".join(f"{c} IS NOT NULL" for c in SERIES))
def q_drop_null_any(spark, sf):
    return C.drop_null_any(hourly_panel(spark, sf))


@query("drop_null_subset", f"WITH {SQL_HOURLY_PANEL} SELECT * FROM panel WHERE purchase IS NOT NULL")
def q_drop_null_subset(spark, sf):
    return C.drop_null_subset(hourly_panel(spark, sf), ["purchase"])


@query("isin_filter", """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_isin_filter(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return C.isin_filter(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("keep_truthy", """SELECT page_id, url FROM (
  SELECT page_id, url, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages)
WHERE title IS NOT NULL AND trim(title) <> ''""")
def q_keep_truthy(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return C.keep_truthy(p, "title").select("page_id", "url")


@query("any_predicate", f"""WITH {SQL_HOURLY_PANEL}
SELECT {", ".join(f"coalesce(bool_or({c} IS NULL), false) AS {c}_has_null" for c in SERIES)},
       coalesce(bool_or(purchase > 99), false) AS purchase_above_99 FROM panel""")
def q_any_predicate(spark, sf):
    p = hourly_panel(spark, sf)
    return p.agg(*[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(f"{c}_has_null") for c in SERIES],
                 F.coalesce(F.bool_or(F.col("purchase") > 99), F.lit(False)).alias("purchase_above_99"))


@query("is_empty", """SELECT 'negative_values' AS probe, count(*) = 0 AS is_empty FROM events WHERE value < 0
UNION ALL SELECT 'all_events', count(*) = 0 FROM events""")
def q_is_empty(spark, sf):
    ev = table(spark, sf, "events")
    a = C.is_empty(ev.filter(F.col("value") < 0)).select(F.lit("negative_values").alias("probe"), "is_empty")
    b = C.is_empty(ev).select(F.lit("all_events").alias("probe"), "is_empty")
    return a.unionByName(b)


@query("parse_date_strict", """SELECT o_orderkey,
  CAST(CAST(strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS TIMESTAMP) AS d1,
  CAST(CAST(strptime(strftime(o_orderdate, '%b %-d, %Y'), '%b %d, %Y') AS DATE) AS TIMESTAMP) AS d2 FROM orders""")
def q_parse_date_strict(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    D.parse_date_strict(F.date_format("o_orderdate", "dd-MM-yyyy"), D.ARTICLE_DATE).alias("d1"),
                    D.parse_date_strict(F.date_format("o_orderdate", "MMM d, yyyy"), D.HISTORY_DATE).alias("d2"))


def _mixed_text():
    return (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd-MM-yyyy"))
            .when(F.col("o_orderpriority") == "1-URGENT", F.lit("not-a-date"))
            .otherwise(F.date_format("o_orderdate", "MMM d, yyyy")))


@query("parse_date_coerce", """SELECT o_orderkey, CAST(coalesce(
    try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%d-%m-%Y'), try_strptime(t, '%b %d, %Y')) AS DATE)::TIMESTAMP AS date
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                              WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d-%m-%Y')
                              WHEN o_orderpriority = '1-URGENT' THEN 'not-a-date'
                              ELSE strftime(o_orderdate, '%b %-d, %Y') END AS t FROM orders)""")
def q_parse_date_coerce(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.parse_date_coerce(_mixed_text()).alias("date"))


@query("format_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders")
def q_format_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.format_date(F.col("o_orderdate")).alias("date_text"))


@query("to_date_part", "SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ship_date FROM lineitem")
def q_to_date_part(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", D.to_date_part(F.col("l_shipdate")).alias("ship_date"))


@query("parse_number", """SELECT o_orderkey, TRY_CAST(replace(printf('%,.2f', o_totalprice), ',', '') AS DOUBLE)
  AS price FROM orders""")
def q_parse_number(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", N.parse_number(F.format_number("o_totalprice", 2)).alias("price"))


@query("to_numeric_coerce", """SELECT event_id, TRY_CAST(trim(CASE WHEN event_id % 2 = 0 THEN CAST(value AS VARCHAR)
  ELSE props END) AS DOUBLE) AS num FROM events""")
def q_to_numeric_coerce(spark, sf):
    ev = table(spark, sf, "events")
    txt = F.when(F.col("event_id") % 2 == 0, F.col("value").cast("string")).otherwise(F.col("props"))
    return ev.select("event_id", N.to_numeric_coerce(txt).alias("num"))


@query("round_half_even", """SELECT l_orderkey, l_linenumber,
  round_even(l_extendedprice * (1 - l_discount) * (1 + l_tax) * 100, 0) / 100 AS charge FROM lineitem""")
def q_round_half_even(spark, sf):
    li = table(spark, sf, "lineitem")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", N.round_half_even(charge, 2).alias("charge"))


@query("date_spine", f"""WITH {SQL_DAILY_ORDERS}
SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date
FROM (SELECT min(date) AS lo, max(date) AS hi FROM daily)""")
def q_date_spine(spark, sf):
    return C.date_spine(daily_orders(spark, sf), "date", "1 day")


@query("null_column", "SELECT event_id, value, CAST(NULL AS DOUBLE) AS missing FROM events")
def q_null_column(spark, sf):
    return C.null_column(table(spark, sf, "events").select("event_id", "value"), "missing")
