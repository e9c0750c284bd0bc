"""Sources, sinks, streaming and scalar-function queries."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..operators import pages as PG
from ..session import table_path
from ..sources import captured as CP
from ..sources import files as IO
from ..sources.snapshots import Snapshots
from ..streaming import keyed as KY
from .fixtures import SERIES, SQL_DAILY_ORDERS, SQL_HOURLY_PANEL, SQL_NEWS, daily_orders, hourly_panel, news
from .quality_queries import CUT, _cells, _sql_metrics, naive_metrics
from .registry import query, round_doubles, table


def _scratch(spark, name):
    return table_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _panel_schema(panel):
    """CSV read schema: the written index, then the panel's own column types."""
    from pyspark.sql import types as T
    return T.StructType([T.StructField("row_index", T.LongType())] + list(panel.schema.fields))


@query("scan_csv", f"WITH {SQL_HOURLY_PANEL} SELECT * FROM panel")
def q_scan_csv(spark, sf):
    from ..operators.ordered import row_index
    path = _scratch(spark, "csv-panel")
    panel = hourly_panel(spark, sf)
    p = row_index(panel, "row_index", order="hour")
    IO.sink_csv(p, path, index="row_index")
    return IO.scan_csv(spark, path, _panel_schema(panel))


@query("scan_table_sql", f"WITH {SQL_HOURLY_PANEL} SELECT hour, purchase FROM panel WHERE purchase > 50")
def q_scan_table_sql(spark, sf):
    hourly_panel(spark, sf).createOrReplaceTempView("panel")
    return IO.scan_table_sql(spark, "SELECT hour, purchase FROM panel WHERE purchase > 50")


_SOURCES = f"""WITH {SQL_NEWS}, d AS (SELECT n.date, n.doc_id, documents.source FROM news n JOIN documents USING (doc_id))"""


def _source_lists(spark, sf):
    """The sources of a day's documents in lists of at most 100 (a day's documents are 30 ids apart)."""
    n = news(spark, sf).join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    own = F.array_sort(F.collect_list(F.struct("doc_id", "source"))).getField("source")
    return n.groupBy("date", F.floor(F.col("doc_id") / 3000).cast("long").alias("part")).agg(own.alias("sources"))


@query("decode_list_columns", f"""{_SOURCES}
SELECT date, doc_id // 3000 AS part, CAST(count(*) AS INT) AS n, string_agg(source, '|' ORDER BY doc_id) AS sources FROM d GROUP BY ALL""")
def q_decode_list_columns(spark, sf):
    # the list as Python prints it: ['src0', 'src1']
    txt = _source_lists(spark, sf).withColumn("sources", F.concat(F.lit("['"), F.array_join("sources", "', '"), F.lit("']")))
    back = IO.decode_list_columns(txt, {"sources": "string"})
    return back.select("date", "part", F.size("sources").alias("n"), F.array_join("sources", "|").alias("sources"))


@query("encode_list_columns", f"""{_SOURCES}
SELECT date, doc_id // 3000 AS part, CAST(to_json(list(source ORDER BY doc_id)) AS VARCHAR) AS sources FROM d GROUP BY ALL""")
def q_encode_list_columns(spark, sf):
    return IO.encode_list_columns(_source_lists(spark, sf))


@query("overwrite_table", f"WITH {SQL_DAILY_ORDERS} SELECT date, value FROM daily")
def q_overwrite_table(spark, sf):
    path = _scratch(spark, "daily")
    d = daily_orders(spark, sf)
    IO.overwrite_table(d.filter(F.col("date") < "1996-01-01"), path)
    IO.overwrite_table(d, path)  # the second write replaces the first
    return spark.read.parquet(path)


@query("sink_csv", f"WITH {SQL_NEWS} SELECT doc_id, date, lang FROM news")
def q_sink_csv(spark, sf):
    path = _scratch(spark, "news-csv")
    IO.sink_csv(news(spark, sf).select("doc_id", "date", "lang"), path)
    return spark.read.option("header", True).schema("doc_id long, date date, lang string").csv(path)


@query("bootstrap_tables", f"""WITH {SQL_NEWS} SELECT date, avg(d.n_chars) AS mean_sentiment_score
FROM news JOIN documents d USING (doc_id) GROUP BY date""")
def q_bootstrap_tables(spark, sf):
    from ..operators.ordered import row_index
    base = _scratch(spark, "bootstrap")
    p = row_index(hourly_panel(spark, sf), "row_index", order="hour")
    IO.sink_csv(p, f"{base}/ticker_csv", index="row_index")
    n = news(spark, sf).join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    daily = n.groupBy("date").agg(F.avg("n_chars").alias("mean_sentiment_score"),
                                  F.count(F.lit(1)).alias("n_news"))
    daily = daily.withColumn("row_index", F.monotonically_increasing_id())
    IO.sink_csv(daily, f"{base}/news_csv", index="row_index")
    out = IO.bootstrap_tables(spark, f"{base}/ticker_csv", f"{base}/news_csv", f"{base}/tables",
                              _panel_schema(hourly_panel(spark, sf)),
                              "row_index long, date date, mean_sentiment_score double, n_news long")
    return spark.read.parquet(out["news_data"])


@query("metric_doc", f"""SELECT 'naive_' || series AS model, round(adjusted_r2, 6) AS test_adjusted_r2
FROM {_sql_metrics()} WHERE split = 'test'""")
def q_metric_doc(spark, sf):
    path = _scratch(spark, "runs")
    m = naive_metrics(spark, sf)
    splits = {s: m.filter(F.col("split") == s).select("series", F.struct("rmse", "mae", "r2", "adjusted_r2").alias(s))
              for s in ("train", "val", "test")}
    rec = splits["train"].join(splits["val"], "series").join(splits["test"], "series").select(
        F.lit("20250613_2209").alias("timestamp"), F.concat(F.lit("naive_"), F.col("series")).alias("model"),
        F.struct("train", "val", "test").alias("scores"))
    IO.metric_doc(rec, path)
    back = spark.read.json(path)
    return round_doubles(back.select("model", F.col("scores.test.adjusted_r2").alias("test_adjusted_r2")))


def _forecasts_sql(upto=None):
    from .quality_queries import _SQL_FORECASTS
    if upto:
        return _SQL_FORECASTS.replace("FROM events GROUP BY 1, 2", f"FROM events WHERE ts < TIMESTAMP '{upto}' GROUP BY 1, 2")
    return _SQL_FORECASTS


@query("kv_upsert", f"""WITH {_forecasts_sql(CUT).replace("fc AS", "fc_old AS").replace("cells AS", "cells_o AS").replace("FROM cells", "FROM cells_o").replace("mom AS", "mom_o AS").replace("JOIN last", "JOIN last_o").replace("last AS", "last_o AS").replace("FROM mom", "FROM mom_o").replace("scen AS", "scen_o AS").replace("FROM scen", "FROM scen_o").replace("FROM last", "FROM last_o")},
{_forecasts_sql()},
old AS (SELECT series || ':' || name AS name, forecast AS value FROM fc_old),
new AS (SELECT series || ':' || name AS name, forecast AS value FROM fc WHERE name IN ('model', 'last_value'))
SELECT coalesce(new.name, old.name) AS name, coalesce(new.value, old.value) AS value FROM old FULL JOIN new ON old.name = new.name""")
def q_kv_upsert(spark, sf):
    from .quality_queries import series_forecasts
    from ..operators.forecast import ensemble_mean, gbm_forecast, last_value
    c = _cells(spark, sf, CUT)
    parts = [gbm_forecast(c, "value", ["series"], "hour", z=z, name=n) for z, n in ((-1.0, "low"), (0.0, "model"), (1.0, "high"))]
    f = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(last_value(c, "value", ["series"], "hour"))
    f = f.unionByName(ensemble_mean(f, ["series"]))
    old = f.select(F.concat_ws(":", "series", "name").alias("name"), F.col("forecast").alias("value"))
    new = (series_forecasts(spark, sf).filter(F.col("name").isin("model", "last_value"))
           .select(F.concat_ws(":", "series", "name").alias("name"), F.col("forecast").alias("value")))
    return IO.kv_upsert(old, new)


@query("rotate_snapshots", f"""SELECT 'ref' AS snapshot, series, split, round(r2, 6) AS r2 FROM {_sql_metrics(CUT)}
UNION ALL SELECT 'previous', series, split, round(r2, 6) FROM {_sql_metrics()}
UNION ALL SELECT 'new', series, split, round(r2, 6) FROM {_sql_metrics()}""")
def q_rotate_snapshots(spark, sf):
    versions = Snapshots(spark, _scratch(spark, "snapshots"))
    cols = ["series", "split", "r2"]
    for part, upto in (("ref", "2024-01-08"), ("previous", CUT), ("new", None)):
        versions.put(naive_metrics(spark, sf, *([upto] if upto else [])).select(*cols), part)
    versions.rotate()
    out = None
    for part in ("ref", "previous", "new"):
        d = versions.read(part).withColumn("snapshot", F.lit(part))
        out = d if out is None else out.unionByName(d)
    return round_doubles(out.select("snapshot", *cols))


# ---------------------------------------------------------------- streaming

def _daily_purchase(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return ev.groupBy(F.to_date("ts").alias("date")).agg(F.max_by("value", "ts").alias("price"))


@query("incremental_ingest", """SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, arg_max(value, ts) AS price
FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def q_incremental_ingest(spark, sf):
    """History to 10 January; then the days behind it as captured folders, and a late row that sends day 5 again with another
    price, taken in two runs of one stream."""
    base = _scratch(spark, "ingest")
    d = _daily_purchase(spark, sf)
    KY.write_history(d.filter(F.col("date") <= "2024-01-10"), f"{base}/target", [], "date", "price")
    late = d.filter(F.col("date") == "2024-01-05").select(F.lit("2024-01-25").cast("date").alias("captured"), "date", F.lit(-1.0).alias("price"))
    rows = d.filter(F.col("date") > "2024-01-10").select(F.col("date").alias("captured"), "date", "price").unionByName(late)
    CP.land(rows.withColumn("pos", F.lit(0).cast("long")), f"{base}/incoming")
    CP.register(spark)
    for seen in ("2024-01-20", "2024-02-10"):
        stream = (spark.readStream.format("captured").schema("captured date, date date, price double, pos long").option("as_of", seen)
                  .load(f"{base}/incoming"))
        out = KY.ingest_days(stream, f"{base}/target", f"{base}/chk", [], "date", "price", "pos", datetime.date(2024, 2, 10))
    return out.select("date", "price")


@query("captured_pages", f"""WITH {SQL_DAILY_ORDERS} SELECT date, round_even(value, 2) AS close FROM daily""")
def q_captured_pages(spark, sf):
    """Price pages captured by month: those behind the stored days are read with the day filter pushed, parsed and merged."""
    from .text_queries import price_pages
    path = _scratch(spark, "captured")
    month = F.to_date(F.col("page_id").cast("string"), "yyyyMM")
    CP.land(price_pages(spark, sf).select(F.last_day(month).alias("captured"), "page_id", F.lit("u").alias("url"), "html"), path)
    old = daily_orders(spark, sf).filter(F.col("date") <= "1998-12-31").withColumnRenamed("value", "close")
    source = CP.CapturedDays(path, lambda p: PG.extract_price_table(p).select("date", "close"))
    return CP.update(old, source, main="close")


@query("daily_sentiment_stream", f"""WITH {SQL_NEWS}
SELECT date, round(avg(d.n_chars / 1000.0), 6) AS mean_score, count(*) AS n FROM news JOIN documents d USING (doc_id) GROUP BY date""")
def q_daily_sentiment_stream(spark, sf):
    base = _scratch(spark, "news-stream")
    n = news(spark, sf).join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    rows = n.select(F.to_date("date").alias("captured"), F.col("date").cast("timestamp").alias("ts"), (F.col("n_chars") / 1000.0).alias("score"))
    CP.land(rows.repartition("captured"), f"{base}/in")
    CP.register(spark)
    for seen in ("2024-01-15", "2024-02-10"):
        stream = (spark.readStream.format("captured").schema("captured date, ts timestamp, score double").option("as_of", seen).load(f"{base}/in"))
        out = KY.daily_scores(stream, f"{base}/target", f"{base}/chk")
    return round_doubles(out)


# ------------------------------------------------------------- scalar functions

@query("date_add_sub", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP) AS next_day,
  CAST(CAST(o_orderdate AS DATE) - 1 AS TIMESTAMP) AS prev_day, CAST(CAST(o_orderdate AS DATE) - 7 AS TIMESTAMP) AS week_ago FROM orders""")
def q_date_add_sub(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", D.shift_days(F.col("d"), 1).alias("next_day"), D.shift_days(F.col("d"), -1).alias("prev_day"),
                    D.shift_days(F.col("d"), -7).alias("week_ago"))


@query("day_of_week", "SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INT) AS weekday FROM orders")
def q_day_of_week(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.weekday(F.col("o_orderdate")).alias("weekday"))


@query("to_daily_period", "SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events")
def q_to_daily_period(spark, sf):
    return table(spark, sf, "events").select("event_id", D.to_date_part(F.col("ts")).alias("day"))


@query("run_stamp", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M') AS run_name, strftime(ts, '%Y-%m-%d') AS day FROM events")
def q_run_stamp(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", D.run_stamp(F.col("ts")).alias("run_name"), D.format_date(F.col("ts")).alias("day"))


@query("ln_exp", "SELECT event_id, round(CASE WHEN value > 0 THEN ln(value) END, 9) AS ln_value, round(exp(value / 100), 9) AS exp_value FROM events")
def q_ln_exp(spark, sf):
    ev = table(spark, sf, "events")
    return round_doubles(ev.select("event_id", N.ln_exp(F.col("value")).alias("ln_value"),
                                   N.ln_exp(F.col("value") / 100, inverse=True).alias("exp_value")), 9)


@query("softmax", """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT vec_id, x, i, exp(x - max(x) OVER (PARTITION BY vec_id)) AS w FROM e),
p AS (SELECT vec_id, i, w / sum(w) OVER (PARTITION BY vec_id) AS p FROM m)
SELECT vec_id, round(max(p), 9) AS p_max, round(max(CASE WHEN i = 2 THEN p END), 9) AS p1 FROM p GROUP BY vec_id""")
def q_softmax(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", N.softmax(F.col("embedding").cast("array<double>")).alias("p"))
    return round_doubles(e.select("vec_id", F.array_max("p").alias("p_max"), F.col("p")[1].alias("p1")), 9)


@query("normal_draw")
def q_normal_draw(spark, sf):
    return table(spark, sf, "events").select("event_id", N.normal_draw(42).alias("z"))


@query("sqrt_abs", "SELECT event_type, round(sqrt(avg((value - 50) * (value - 50))), 6) AS rmse, round(avg(abs(value - 50)), 6) AS mae FROM events GROUP BY 1")
def q_sqrt_abs(spark, sf):
    ev = table(spark, sf, "events")
    e = F.col("value") - 50
    return round_doubles(ev.groupBy("event_type").agg(N.rmse(e).alias("rmse"), F.avg(F.abs(e)).alias("mae")))


@query("nested_get", f"""SELECT series, coalesce(adjusted_r2, -1.0) AS test_adjusted_r2 FROM {_sql_metrics()} WHERE split = 'test'""")
def q_nested_get(spark, sf):
    m = naive_metrics(spark, sf).filter(F.col("split") == "test")
    doc = m.select("series", F.struct(F.struct(F.col("adjusted_r2")).alias("test")).alias("scores"))
    return doc.select("series", N.nested_get("scores.test.adjusted_r2", -1.0).alias("test_adjusted_r2"))


@query("array_mean", """SELECT vec_id, round(avg(CAST(e AS DOUBLE)), 6) AS mean FROM (SELECT vec_id, unnest(embedding) AS e FROM embeddings) GROUP BY vec_id""")
def q_array_mean(spark, sf):
    e = table(spark, sf, "embeddings")
    return round_doubles(e.select("vec_id", N.array_mean(F.col("embedding")).alias("mean")))
