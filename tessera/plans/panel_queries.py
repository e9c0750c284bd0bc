"""Flagship panel query and the ordered operators on the hourly panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordered as O
from .fixtures import MAIN, SERIES, SQL_DAILY_ORDERS, SQL_HOURLY_PANEL, daily_orders, hourly_panel
from .registry import query, round_doubles

_PCT = ",\n".join(
    f"(({c} / nullif(lag({c}) OVER w, 0)) - 1) * 100 AS {c}_pct_chg" for c in SERIES)
_FILL = ",\n".join(f"first_value({c} IGNORE NULLS) OVER f AS {c}" for c in SERIES)


def panel_features(spark, sf_dir):
    """events -> hourly pivot on a spine -> back-fill -> returns -> next-hour target ->
    chronological split. Returns and target come from one shift pass."""
    p = hourly_panel(spark, sf_dir).checkpoint(eager=True)  # the pivot is read by the cuts and by each step
    cuts = O.row_buckets(p, "hour")
    p = O.backfill(p, SERIES, order="hour", bucket=cuts)
    specs = {f"__prev_{c}": (c, 1) for c in SERIES}
    specs["target"] = (MAIN, -1)
    p = O.shift(p, specs, order="hour", bucket=cuts)
    p = p.withColumns({f"{c}_pct_chg": (F.try_divide(F.col(c), F.col(f"__prev_{c}")) - 1) * 100
                       for c in SERIES}).drop(*[f"__prev_{c}" for c in SERIES])
    p = O.chronological_split(p, order="hour", bucket=cuts)
    return round_doubles(p)


query("panel_features", f"""
WITH {SQL_HOURLY_PANEL},
filled AS (SELECT hour, {_FILL} FROM panel
           WINDOW f AS (ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
feat AS (SELECT *, {_PCT},
    lead(purchase) OVER w AS target,
    row_number() OVER w AS rn, count(*) OVER () AS n
  FROM filled WINDOW w AS (ORDER BY hour))
SELECT hour, {", ".join(f"round({c}, 6) AS {c}" for c in SERIES)},
       {", ".join(f"round({c}_pct_chg, 6) AS {c}_pct_chg" for c in SERIES)},
       round(target, 6) AS target,
       CASE WHEN rn <= floor(n * 0.6::DOUBLE) THEN 'train'
            WHEN rn <= floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'val'
            ELSE 'test' END AS split
FROM feat
""")(panel_features)


# ----------------------------------------------------------- ordered operators

_D = f"WITH {SQL_DAILY_ORDERS}"


@query("pct_change", f"""{_D}
SELECT date, value, round((value / nullif(lag(value) OVER (ORDER BY date), 0) - 1) * 100, 6) AS value_pct_chg
FROM daily""")
def q_pct_change(spark, sf):
    return round_doubles(O.pct_change(daily_orders(spark, sf), ["value"], order="date"))


@query("lead_target", f"""WITH {SQL_HOURLY_PANEL},
full_rows AS (SELECT * FROM panel WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SERIES)})
SELECT *, lead(purchase) OVER (ORDER BY hour) AS target FROM full_rows""")
def q_lead_target(spark, sf):
    p = hourly_panel(spark, sf).na.drop("any")
    return O.lead_target(p, MAIN, "target", order="hour")


@query("log_return", f"""{_D}
SELECT date, value, round(CASE WHEN value / lag(value) OVER (ORDER BY date) > 0
   THEN ln(value / lag(value) OVER (ORDER BY date)) END, 9) AS value_log_ret FROM daily""")
def q_log_return(spark, sf):
    out = O.log_return(daily_orders(spark, sf), "value", order="date")
    return out.withColumn("value_log_ret", F.round("value_log_ret", 9))


@query("backward_fill", f"""WITH {SQL_HOURLY_PANEL}
SELECT hour, {_FILL} FROM panel
WINDOW f AS (ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def q_backward_fill(spark, sf):
    return O.backfill(hourly_panel(spark, sf), SERIES, order="hour")


@query("gap_segment_average", f"""WITH {SQL_HOURLY_PANEL},
seg AS (SELECT *, coalesce(count(purchase) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS s FROM panel)
SELECT hour, purchase, round(avg(click) OVER (PARTITION BY s), 6) AS score FROM seg""")
def q_gap_segment_average(spark, sf):
    p = hourly_panel(spark, sf).select("hour", "click", "purchase")
    out = O.gap_segment_average(p, "click", "purchase", name="score", order="hour")
    return round_doubles(out.select("hour", "purchase", "score"))


@query("row_index", f"""{_D} SELECT date, row_number() OVER (ORDER BY date) AS row_index FROM daily""")
def q_row_index(spark, sf):
    return O.row_index(daily_orders(spark, sf).select("date"), order="date")


@query("chronological_split", f"""{_D}
SELECT date, value, CASE WHEN rn <= floor(n * 0.6::DOUBLE) THEN 'train'
  WHEN rn <= floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM daily)""")
def q_chronological_split(spark, sf):
    return O.chronological_split(daily_orders(spark, sf), order="date")


@query("lag_matrix", """WITH cells AS (
  SELECT date_trunc('hour', ts) AS hour, event_type, arg_max(value, ts) AS value FROM events GROUP BY 1, 2)
SELECT hour, event_type, value, """ + ", ".join(
    f"lag(value, {i}) OVER (PARTITION BY event_type ORDER BY hour) AS value_lag{i}" for i in range(1, 6))
       + " FROM cells")
def q_lag_matrix(spark, sf):
    from .fixtures import hourly_cells
    cells = (hourly_cells(spark, sf).groupBy("hour", "event_type")
             .agg(F.max_by("value", "ts").alias("value")))
    return O.lag_matrix(cells, "value", 5, keys=["event_type"], order="hour", bucket="day")


@query("difference", f"""{_D} SELECT date, value, round(value - lag(value) OVER (ORDER BY date), 6) AS value_diff
FROM daily""")
def q_difference(spark, sf):
    return round_doubles(O.difference(daily_orders(spark, sf), "value", order="date"))


@query("sequence_windows", f"""{_D},
w AS (SELECT date, list(value) OVER (ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS win FROM daily)
SELECT date, CAST(i AS BIGINT) AS offset, round(win[i], 6) AS value
FROM (SELECT date, win, unnest(range(1, 11)) AS i FROM w WHERE len(win) = 10)""")
def q_sequence_windows(spark, sf):
    out = O.sequence_windows(daily_orders(spark, sf), "value", 10, order="date")
    ex = out.select("date", F.posexplode("window").alias("offset", "value"))
    return round_doubles(ex.withColumn("offset", (F.col("offset") + 1).cast("long")))


# ---------------------------------------------------------------- joins

from ..operators import panel as P  # noqa: E402
from .fixtures import SQL_NEWS, news  # noqa: E402
from .registry import table  # noqa: E402


def _daily_purchase(spark, sf):
    """Daily price: last purchase value of the day (events)."""
    ev = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return ev.groupBy(F.to_date("ts").alias("date")).agg(F.max_by("value", "ts").alias("price"))


_SQL_DAILY_PURCHASE = """dprice AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, arg_max(value, ts) AS price
  FROM events WHERE event_type = 'purchase' GROUP BY 1)"""


query("spine_left_join", f"WITH {SQL_HOURLY_PANEL} SELECT * FROM panel")(
    lambda spark, sf: hourly_panel(spark, sf))


@query("sentiment_price_join", f"""WITH {SQL_NEWS}, {_SQL_DAILY_PURCHASE}
SELECT n.doc_id, n.date, p.price FROM news n LEFT JOIN dprice p ON n.date = p.date""")
def q_sentiment_price_join(spark, sf):
    n = news(spark, sf).select("doc_id", "date")
    return P.sentiment_price_join(n, _daily_purchase(spark, sf), "date")


@query("semi_join_dates", """SELECT l_orderkey, l_linenumber FROM lineitem
WHERE CAST(l_shipdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')""")
def q_semi_join_dates(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"))
    urgent = (table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
              .select(F.to_date("o_orderdate").alias("date")))
    return P.semi_join_dates(li, urgent, "date").select("l_orderkey", "l_linenumber")


# ---------------------------------------------------------- aggregations

@query("high_water_mark", """SELECT 'orders' AS source, CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS high_water_mark FROM orders
UNION ALL SELECT 'empty', CAST(coalesce(max(CAST(ts AS DATE)), DATE '2024-02-01' - 7) AS TIMESTAMP) FROM events WHERE value < 0""")
def q_high_water_mark(spark, sf):
    o = P.high_water_mark(table(spark, sf, "orders"), "o_orderdate", as_of="2024-02-01")
    e = P.high_water_mark(table(spark, sf, "events").filter(F.col("value") < 0), "ts", as_of="2024-02-01")
    return (o.select(F.lit("orders").alias("source"), "high_water_mark")
            .unionByName(e.select(F.lit("empty").alias("source"), "high_water_mark")))


@query("group_collect", f"""WITH {SQL_NEWS}
SELECT date, CAST(count(*) AS BIGINT) AS n_items, md5(string_agg(text, chr(31) ORDER BY doc_id)) AS items_md5
FROM news GROUP BY date""")
def q_group_collect(spark, sf):
    g = P.group_collect(news(spark, sf), "date", "text", ["doc_id"], name="items")
    n = news(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n_items"))
    return O._join(n, P.ordered_digest(g, "date", "items", "\u001f", "items_md5"), ["date"])


@query("missing_ratio_columns", f"""WITH {SQL_HOURLY_PANEL}
SELECT {", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS {c}" for c in ["hour"] + SERIES)} FROM panel""")
def q_missing_ratio_columns(spark, sf):
    from ..operators.quality import missing_ratio_columns
    return round_doubles(missing_ratio_columns(hourly_panel(spark, sf)))


@query("missing_ratio_rows", f"""WITH {SQL_HOURLY_PANEL}
SELECT hour, round(({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in ["hour"] + SERIES)}) / 6.0, 6)
  AS missing_ratio FROM panel""")
def q_missing_ratio_rows(spark, sf):
    from ..operators.quality import missing_ratio_rows
    p = hourly_panel(spark, sf)
    return round_doubles(missing_ratio_rows(p).select("hour", "missing_ratio"))


@query("quantiles", "SELECT " + ", ".join(
    f"quantile_cont({c}, {p}) AS {c}_q{int(p * 100)}" for c in ("l_quantity", "l_extendedprice", "l_discount")
    for p in (0.25, 0.75)) + " FROM lineitem")
def q_quantiles(spark, sf):
    return round_doubles(P.quantiles(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query("return_moments", f"""{_D}, r AS (SELECT ln(value / lag(value) OVER (ORDER BY date)) AS lr FROM daily)
SELECT round(avg(lr), 9) AS mu, round(stddev_samp(lr), 9) AS sigma, CAST(count(lr) AS BIGINT) AS n FROM r""")
def q_return_moments(spark, sf):
    from ..operators.forecast import return_moments
    out = return_moments(daily_orders(spark, sf), "value", order="date")
    return out.select(F.round("mu", 9).alias("mu"), F.round("sigma", 9).alias("sigma"), "n")


@query("row_count", "SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def q_row_count(spark, sf):
    return P.row_count(table(spark, sf, "lineitem"))


@query("distinct_rows", "SELECT DISTINCT * FROM lineitem")
def q_distinct_rows(spark, sf):
    return P.distinct_rows(table(spark, sf, "lineitem"))


@query("dedupe_keep_last", """SELECT event_type, user_id, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value,
  max(ts) AS ts FROM events GROUP BY event_type, user_id""")
def q_dedupe_keep_last(spark, sf):
    ev = table(spark, sf, "events").select("event_type", "user_id", "event_id", "value", "ts")
    return P.dedupe_keep_last(ev, ["event_type", "user_id"], ["ts"])


# --------------------------------------------------------- set operations

@query("union_all", """SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment,
  NULL::VARCHAR AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier' FROM supplier""")
def q_union_all(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                             F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                             F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("kind"))
    return P.union_all(c, s)


@query("combine_splits", f"""{_D}
SELECT date, value FROM (SELECT *, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM daily)
WHERE rn <= floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE)""")
def q_combine_splits(spark, sf):
    s = O.chronological_split(daily_orders(spark, sf), order="date")
    return P.combine_splits(s).drop("split")


def _batches(spark, sf):
    """Hourly panel as two ingest batches: history up to 2024-01-16 and a new pull from
    2024-01-15 (the overlap day repeats; the later batch wins)."""
    p = hourly_panel(spark, sf).withColumn("date", F.col("hour")).drop("hour")
    old = p.filter(F.col("date") < "2024-01-16").withColumn("__batch", F.lit(0))
    new = p.filter(F.col("date") >= "2024-01-15").withColumn("__batch", F.lit(1))
    stamp = lambda d: d.withColumn("__pos_in", F.unix_micros(F.col("date").cast("timestamp")))
    return stamp(old), stamp(new)


@query("incremental_upsert", f"""WITH {SQL_HOURLY_PANEL},
b AS (SELECT hour AS date, *, 0 AS batch FROM panel WHERE hour < TIMESTAMP '2024-01-16'
      UNION ALL SELECT hour AS date, *, 1 FROM panel WHERE hour >= TIMESTAMP '2024-01-15'),
k AS (SELECT * FROM b WHERE purchase IS NOT NULL),
f AS (SELECT date, batch, {", ".join(f"first_value({c} IGNORE NULLS) OVER w AS {c}" for c in SERIES)} FROM k
      WINDOW w AS (ORDER BY batch, date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY date ORDER BY batch DESC) = 1)
SELECT date, {", ".join(f"round_even({c} * 100, 0) / 100 AS {c}" for c in SERIES)} FROM l""")
def q_incremental_upsert(spark, sf):
    old, new = _batches(spark, sf)
    out = P.incremental_upsert(old, new, date="date", main=MAIN)
    return out.drop("__batch", "__pos_in")


@query("news_append", f"""WITH {SQL_NEWS}
SELECT doc_id, date FROM news WHERE date < TIMESTAMP '2024-01-20'
UNION ALL SELECT doc_id, date FROM news WHERE date >= TIMESTAMP '2024-01-10'""")
def q_news_append(spark, sf):
    n = news(spark, sf).select("doc_id", "date")
    return P.news_append(n.filter(F.col("date") < "2024-01-20"), n.filter(F.col("date") >= "2024-01-10"))


@query("column_set_diff", """SELECT column_name AS "column" FROM (VALUES ('hour'), ('click'), ('error'),
  ('purchase'), ('signup'), ('view'), ('vix'), ('nsei')) t(column_name)
WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE SELECT date_trunc('hour', ts) AS hour, * FROM events))
  AND column_name NOT IN ('click', 'error', 'purchase', 'signup', 'view')""")
def q_column_set_diff(spark, sf):
    present = hourly_panel(spark, sf).columns
    required = ["hour", "click", "error", "purchase", "signup", "view", "vix", "nsei"]
    return P.column_set_diff(spark, required, present)


# ----------------------------------------------------------- sort / limit

@query("sort_by_date", f"{_D} SELECT date, value FROM daily ORDER BY date")
def q_sort_by_date(spark, sf):
    return P.sort_by(daily_orders(spark, sf), ["date"])


@query("last_row", f"WITH {SQL_HOURLY_PANEL} SELECT * FROM panel ORDER BY hour DESC LIMIT 1")
def q_last_row(spark, sf):
    return P.last_row(hourly_panel(spark, sf), "hour")


@query("all_but_last", f"""WITH {SQL_HOURLY_PANEL}
SELECT hour, purchase, target FROM (SELECT hour, purchase, lead(purchase) OVER (ORDER BY hour) AS target FROM panel)
WHERE target IS NOT NULL""")
def q_all_but_last(spark, sf):
    p = O.lead_target(hourly_panel(spark, sf).select("hour", "purchase"), MAIN, order="hour")
    return P.all_but_last(p, "target")


@query("first_entry", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""")
def q_first_entry(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return P.first_entry(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("head_tail", f"""{_D} (SELECT 'head' AS part, date, value FROM daily ORDER BY date LIMIT 5)
UNION ALL (SELECT 'tail', date, value FROM daily ORDER BY date DESC LIMIT 5)""")
def q_head_tail(spark, sf):
    d = daily_orders(spark, sf)
    h = P.head_tail(d, ["date"], 5).select(F.lit("head").alias("part"), "date", "value")
    t = P.head_tail(d, ["date"], 5, tail=True).select(F.lit("tail").alias("part"), "date", "value")
    return h.unionByName(t)
