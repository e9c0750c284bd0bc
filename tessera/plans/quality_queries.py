"""Data-quality checks, drift and gates and AGG-09 metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as DR
from ..operators import ordered as O
from ..operators import quality as Q
from ..operators.forecast import ensemble_mean, gbm_forecast, last_value
from ..operators.metrics import regression_metrics
from .fixtures import SQL_HOURLY_PANEL, hourly_panel
from .registry import query, round_doubles, table

CUT = "2024-01-16"


def final_table(spark, sf):
    """The reference's final table shape from the hourly panel: a score and prices."""
    p = hourly_panel(spark, sf)
    return p.select(F.col("hour").alias("date"), ((F.col("click") - 50) / 40).alias("mean_sentiment_score"),
                    F.col("error").alias("crude_oil"), F.col("signup").alias("gold"),
                    F.col("view").alias("vix"), F.col("purchase").alias("nsei"))


SQL_FINAL = SQL_HOURLY_PANEL + """,
final AS (SELECT hour AS date, (click - 50) / 40 AS mean_sentiment_score, error AS crude_oil, signup AS gold,
                 view AS vix, purchase AS nsei FROM panel)"""

_FIND = "CAST({c} AS VARCHAR) AS check, CAST({col} AS VARCHAR) AS \"column\", CAST({k} AS VARCHAR) AS row_key, CAST({d} AS VARCHAR) AS detail"


def _f(c, col, k, d):
    return _FIND.format(c=c, col=col, k=k, d=d)


@query("check_columns", f"""WITH {SQL_FINAL}
SELECT {_f("'missing_column'", "name", "NULL", "NULL")} FROM (VALUES {", ".join(f"('{c}', {i})" for i, c in enumerate(Q.REQUIRED_COLUMNS))}) r(name, i)
WHERE name NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM final))""")
def q_check_columns(spark, sf):
    return Q.check_columns(final_table(spark, sf))


def _typed_text(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 97 == 0, F.lit("not-a-date")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("event_id") % 89 == 0, F.lit("abc")).otherwise(F.col("value").cast("string")).alias("price"))


@query("check_dtypes", f"""WITH t AS (SELECT event_id AS id,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d') END AS date,
    CASE WHEN event_id % 89 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR) END AS price FROM events)
SELECT {_f("'bad_date'", "'date'", "id", "date")} FROM t WHERE date IS NOT NULL AND try_strptime(date, '%Y-%m-%d') IS NULL
UNION ALL SELECT {_f("'bad_number'", "'price'", "id", "price")} FROM t WHERE price IS NOT NULL AND TRY_CAST(trim(price) AS DOUBLE) IS NULL""")
def q_check_dtypes(spark, sf):
    return Q.check_dtypes(_typed_text(spark, sf), "id", ["date"], ["price"])


@query("check_missing", f"""WITH {SQL_HOURLY_PANEL},
r AS (SELECT *, ((CASE WHEN click IS NULL THEN 1 ELSE 0 END) + (CASE WHEN error IS NULL THEN 1 ELSE 0 END)
   + (CASE WHEN purchase IS NULL THEN 1 ELSE 0 END) + (CASE WHEN signup IS NULL THEN 1 ELSE 0 END)
   + (CASE WHEN view IS NULL THEN 1 ELSE 0 END)) / 6.0 AS ratio, CASE WHEN hour >= TIMESTAMP '{CUT}' THEN click END AS late FROM panel)
SELECT {_f("'column_missing'", "'late'", "NULL", "(SELECT printf('%.4f', avg(CASE WHEN late IS NULL THEN 1.0 ELSE 0.0 END)) FROM r)")}
WHERE (SELECT avg(CASE WHEN late IS NULL THEN 1.0 ELSE 0.0 END) FROM r) >= 0.4
UNION ALL SELECT {_f("'row_missing'", "NULL", "strftime(hour, '%Y-%m-%d %H:%M:%S')", "printf('%.4f', ratio)")} FROM r WHERE ratio >= 0.4
UNION ALL SELECT {_f("'null_left'", "NULL", "strftime(hour, '%Y-%m-%d %H:%M:%S')", "NULL")} FROM r
WHERE ratio < 0.4 AND ratio > 0""")
def q_check_missing(spark, sf):
    """With a column that starts late, so that it goes before rows are judged."""
    late = F.when(F.col("hour") >= CUT, F.col("click"))
    findings, _ = Q.check_missing(hourly_panel(spark, sf).withColumn("late", late), "hour")
    return findings


def faulty_table(spark, sf):
    """The final table with prices below 0 and a day that is there twice."""
    d = final_table(spark, sf).withColumn("crude_oil", F.col("crude_oil") - 20)
    return d.unionByName(d.filter((F.col("date") >= "2024-01-05") & (F.col("date") < "2024-01-06")))


SQL_FAULTY = SQL_FINAL + """,
less AS (SELECT * REPLACE (crude_oil - 20 AS crude_oil) FROM final),
faulty AS (SELECT * FROM less UNION ALL SELECT * FROM less WHERE date >= TIMESTAMP '2024-01-05' AND date < TIMESTAMP '2024-01-06')"""


@query("check_ranges", f"""WITH {SQL_FAULTY}
SELECT {_f("'score_range'", "'mean_sentiment_score'", "strftime(date, '%Y-%m-%d %H:%M:%S')", "mean_sentiment_score")} FROM faulty
WHERE mean_sentiment_score < -1 OR mean_sentiment_score > 1
UNION ALL SELECT {_f("'negative_price'", "'crude_oil'", "strftime(date, '%Y-%m-%d %H:%M:%S')", "round(crude_oil, 6)")} FROM faulty WHERE crude_oil < 0""")
def q_check_ranges(spark, sf):
    d = faulty_table(spark, sf)
    return Q.check_ranges(d.withColumn("crude_oil", F.round("crude_oil", 6)), "date")


_LI = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


@query("check_duplicates", f"""WITH li AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0)
SELECT 'duplicate_row' AS check, CAST(NULL AS VARCHAR) AS "column", concat_ws('|', {", ".join(f"CAST({c} AS VARCHAR)" for c in _LI)}) AS row_key,
  CAST(count(*) - 1 AS VARCHAR) AS detail FROM li GROUP BY {", ".join(_LI)} HAVING count(*) > 1""")
def q_check_duplicates(spark, sf):
    """All columns of the table, a fiftieth of whose rows is there twice."""
    li = table(spark, sf, "lineitem").select(*_LI)
    return Q.check_duplicates(li.unionByName(li.filter(F.col("l_orderkey") % 50 == 0)))


@query("check_future_dates", f"""SELECT {_f("'future_date'", "'ts'", "event_id", "strftime(ts, '%Y-%m-%d %H:%M:%S')")}
FROM events WHERE ts > TIMESTAMP '2024-01-29 12:00:00'""")
def q_check_future_dates(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    return Q.check_future_dates(ev, "ts", as_of="2024-01-29 12:00:00", key="event_id")


@query("run_all_checks", f"""WITH {SQL_FAULTY}, k AS (SELECT * FROM faulty WHERE mean_sentiment_score IS NOT NULL
   AND crude_oil IS NOT NULL AND gold IS NOT NULL AND vix IS NOT NULL AND nsei IS NOT NULL)
SELECT "check", count(*) AS n FROM (
  SELECT 'missing_column' AS "check" FROM (VALUES {", ".join(f"('{c}')" for c in Q.REQUIRED_COLUMNS)}) r(name)
    WHERE name NOT IN ('date', 'mean_sentiment_score', 'crude_oil', 'gold', 'vix', 'nsei')
  UNION ALL SELECT 'score_range' FROM k WHERE mean_sentiment_score < -1 OR mean_sentiment_score > 1
  UNION ALL SELECT 'negative_price' FROM k WHERE crude_oil < 0
  UNION ALL SELECT 'duplicate_row' FROM (SELECT 1 FROM k GROUP BY date, mean_sentiment_score, crude_oil, gold, vix, nsei HAVING count(*) > 1)
  UNION ALL SELECT 'future_date' FROM k WHERE date > TIMESTAMP '2024-01-29 12:00:00')
GROUP BY 1""")
def q_run_all_checks(spark, sf):
    f = Q.run_all_checks(faulty_table(spark, sf), "date", as_of="2024-01-29 12:00:00")
    return f.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- drift / gates

def _cells(spark, sf, upto=None):
    ev = table(spark, sf, "events")
    if upto:
        ev = ev.filter(F.col("ts") < upto)
    return (ev.groupBy(F.date_trunc("hour", "ts").alias("hour"), F.col("event_type").alias("series"))
            .agg(F.max_by("value", "ts").alias("value")))


def naive_metrics(spark, sf, upto=None):
    """Per series: previous-hour value as the forecast, metrics per chronological split."""
    c = _cells(spark, sf, upto)
    c = O.lag(c, "value", 1, "prediction", keys=["series"], order="hour", bucket="day")
    c = O.chronological_split(c, keys=["series"], order="hour", bucket="day")
    return regression_metrics(c, "value", "prediction", ["series", "split"], n_features=1)


def _sql_metrics(upto=None):
    w = f"WHERE ts < TIMESTAMP '{upto}'" if upto else ""
    return f"""(SELECT series, split, n, rmse, mae, r2, CASE WHEN n - 2 > 0 THEN 1 - (1 - r2) * (n - 1) / (n - 2) END AS adjusted_r2
FROM (SELECT series, split, count(*) AS n, sqrt(avg((value - prediction) ^ 2)) AS rmse, avg(abs(value - prediction)) AS mae,
   1 - sum((value - prediction) ^ 2) / nullif(var_pop(value) * count(*), 0) AS r2
 FROM (SELECT *, CASE WHEN rn <= floor(n * 0.6::DOUBLE) THEN 'train'
            WHEN rn <= floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'val' ELSE 'test' END AS split
   FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY hour) AS prediction,
           row_number() OVER (PARTITION BY series ORDER BY hour) AS rn, count(*) OVER (PARTITION BY series) AS n
         FROM (SELECT date_trunc('hour', ts) AS hour, event_type AS series, arg_max(value, ts) AS value
               FROM events {w} GROUP BY 1, 2)))
 WHERE prediction IS NOT NULL GROUP BY 1, 2))"""


@query("regression_metrics", f"""SELECT series, split, CAST(n AS BIGINT) AS n, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
  round(r2, 6) AS r2, round(adjusted_r2, 6) AS adjusted_r2 FROM {_sql_metrics()}""")
def q_regression_metrics(spark, sf):
    return round_doubles(naive_metrics(spark, sf))


@query("score_gate", f"""SELECT series, bool_and(coalesce(r2, 0) >= 0.9 AND coalesce(adjusted_r2, 0) >= 0.9)
  AND count(DISTINCT split) = 3 AS score_gate FROM {_sql_metrics()} GROUP BY series""")
def q_score_gate(spark, sf):
    return DR.score_gate(naive_metrics(spark, sf))


def _test_adj(m):
    return m.filter(F.col("split") == "test").select("series", F.col("adjusted_r2").alias("test_adjusted_r2"))


@query("model_drift", f"""SELECT coalesce(p.series, c.series) AS series, round(p.adjusted_r2 - c.adjusted_r2, 6) AS "drop",
  coalesce(p.adjusted_r2 - c.adjusted_r2 > 0.05, false) AS model_drift
FROM (SELECT * FROM {_sql_metrics(CUT)} WHERE split = 'test') p
FULL JOIN (SELECT * FROM {_sql_metrics()} WHERE split = 'test') c ON p.series = c.series""")
def q_model_drift(spark, sf):
    prev = _test_adj(naive_metrics(spark, sf, CUT))
    cur = _test_adj(naive_metrics(spark, sf))
    return round_doubles(DR.model_drift(prev, cur))


def series_forecasts(spark, sf):
    """Per series: GBM scenarios (Z = -1, 0, 1; Z = 0 is the model), their average and
    the last value."""
    c = _cells(spark, sf)
    parts = [gbm_forecast(c, "value", ["series"], "hour", z=z, name=n)
             for z, n in ((-1.0, "low"), (0.0, "model"), (1.0, "high"))]
    f = parts[0].unionByName(parts[1]).unionByName(parts[2])
    f = f.unionByName(last_value(c, "value", ["series"], "hour"))
    return f.unionByName(ensemble_mean(f, ["series"]))


_SQL_FORECASTS = """cells AS (SELECT date_trunc('hour', ts) AS hour, event_type AS series, arg_max(value, ts) AS value
  FROM events GROUP BY 1, 2),
mom AS (SELECT series, avg(lr) AS mu, stddev_samp(lr) AS sigma FROM (
  SELECT series, CASE WHEN value / lag(value) OVER (PARTITION BY series ORDER BY hour) > 0
    THEN ln(value / lag(value) OVER (PARTITION BY series ORDER BY hour)) END AS lr FROM cells) GROUP BY series),
last AS (SELECT series, arg_max(value, hour) AS s FROM cells GROUP BY series),
scen AS (SELECT series, name, round_even(s * exp((mu - sigma * sigma / 2) + sigma * z) * 100, 0) / 100 AS forecast
  FROM mom JOIN last USING (series) JOIN (VALUES ('low', -1.0), ('model', 0.0), ('high', 1.0)) t(name, z) ON true),
fc AS (SELECT * FROM scen UNION ALL SELECT series, 'last_value', s FROM last
  UNION ALL SELECT series, 'average_expected', round_even(avg(forecast) * 100, 0) / 100 FROM scen GROUP BY series)"""


@query("gbm_forecast", f"""WITH {_SQL_FORECASTS} SELECT series, name, forecast FROM fc WHERE name = 'model'""")
def q_gbm_forecast(spark, sf):
    return gbm_forecast(_cells(spark, sf), "value", ["series"], "hour", z=0.0, name="model")


@query("ensemble_mean", f"""WITH {_SQL_FORECASTS} SELECT series, name, forecast FROM fc WHERE name = 'average_expected'""")
def q_ensemble_mean(spark, sf):
    return series_forecasts(spark, sf).filter(F.col("name") == "average_expected")


@query("direction_gate", f"""WITH {_SQL_FORECASTS},
p AS (SELECT series, max(forecast) FILTER (WHERE name = 'model') AS m, max(forecast) FILTER (WHERE name = 'average_expected') AS a,
  max(forecast) FILTER (WHERE name = 'last_value') AS l FROM fc GROUP BY series)
SELECT series, coalesce((m > l AND a > l) OR (m < l AND a < l), false) AS direction_gate FROM p""")
def q_direction_gate(spark, sf):
    return DR.direction_gate(series_forecasts(spark, sf))


def _halves(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_type").alias("series"), "value", "ts")
    return ev.filter(F.col("ts") < CUT).drop("ts"), ev.filter(F.col("ts") >= CUT).drop("ts")


_SQL_KS = """a AS (SELECT event_type AS series, value FROM events WHERE ts < TIMESTAMP '2024-01-16' AND value IS NOT NULL),
b AS (SELECT event_type AS series, value FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND value IS NOT NULL),
v AS (SELECT series, value, sum(ca) AS ca, sum(cb) AS cb FROM (SELECT series, value, 1 AS ca, 0 AS cb FROM a
      UNION ALL SELECT series, value, 0, 1 FROM b) GROUP BY 1, 2),
c AS (SELECT series, value, sum(ca) OVER w / sum(ca) OVER (PARTITION BY series) AS fa,
             sum(cb) OVER w / sum(cb) OVER (PARTITION BY series) AS fb,
             sum(ca) OVER (PARTITION BY series) AS na, sum(cb) OVER (PARTITION BY series) AS nb
      FROM v WINDOW w AS (PARTITION BY series ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT series, 'value' AS "column", max(abs(fa - fb)) AS d, CAST(max(na) AS BIGINT) AS n_a, CAST(max(nb) AS BIGINT) AS n_b
      FROM c GROUP BY series),
ks AS (SELECT *, (SELECT least(greatest(sum(2.0 * CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END
          * exp(-2.0 * k * k * (sqrt(n_a * n_b / (n_a + n_b)) * d) ^ 2)), 0), 1) FROM range(1, 101) t(k)) AS p_value FROM d)"""


@query("ks_drift", f"""WITH {_SQL_KS} SELECT series, "column", round(d, 9) AS d, n_a, n_b, round(p_value, 9) AS p_value FROM ks""")
def q_ks_drift(spark, sf):
    a, b = _halves(spark, sf)
    s = DR.ks_statistics(a, b, ["value"], keys=["series"])
    return s.select("series", "column", F.round("d", 9).alias("d"), F.col("n_a").cast("long").alias("n_a"),
                    F.col("n_b").cast("long").alias("n_b"), F.round("p_value", 9).alias("p_value"))


@query("promotion_gate", f"""WITH {_SQL_FORECASTS}, {_SQL_KS},
dir AS (SELECT series, coalesce((m > l AND a > l) OR (m < l AND a < l), false) AS direction_gate FROM (
  SELECT series, max(forecast) FILTER (WHERE name = 'model') AS m, max(forecast) FILTER (WHERE name = 'average_expected') AS a,
  max(forecast) FILTER (WHERE name = 'last_value') AS l FROM fc GROUP BY series)),
sg AS (SELECT series, bool_and(coalesce(r2, 0) >= 0.9 AND coalesce(adjusted_r2, 0) >= 0.9) AND count(DISTINCT split) = 3 AS score_gate
  FROM {_sql_metrics()} GROUP BY series),
md AS (SELECT coalesce(p.series, c.series) AS series, coalesce(p.adjusted_r2 - c.adjusted_r2 > 0.05, false) AS model_drift
  FROM (SELECT * FROM {_sql_metrics(CUT)} WHERE split = 'test') p
  FULL JOIN (SELECT * FROM {_sql_metrics()} WHERE split = 'test') c ON p.series = c.series),
g AS (SELECT series, p_value < 0.05 AS drift, model_drift, score_gate, direction_gate
  FROM ks JOIN md USING (series) JOIN sg USING (series) JOIN dir USING (series))
SELECT series, array_to_string(list_filter([CASE WHEN drift THEN 'data drift' END, CASE WHEN model_drift THEN 'model drift' END,
   CASE WHEN NOT score_gate THEN 'score below threshold' END, CASE WHEN NOT direction_gate THEN 'direction mismatch' END],
   lambda x: x IS NOT NULL), '; ') AS reasons,
  CASE WHEN drift OR model_drift OR NOT score_gate OR NOT direction_gate THEN 'staging' ELSE 'production' END AS stage FROM g""")
def q_promotion_gate(spark, sf):
    a, b = _halves(spark, sf)
    drift = DR.ks_drift(a, b, ["value"], keys=["series"])
    md = DR.model_drift(_test_adj(naive_metrics(spark, sf, CUT)), _test_adj(naive_metrics(spark, sf))).drop("drop")
    sg = DR.score_gate(naive_metrics(spark, sf))
    dg = DR.direction_gate(series_forecasts(spark, sf))
    g = drift.join(md, "series").join(sg, "series").join(dg, "series")
    out = DR.promotion_gate(g)
    return out.select("series", F.array_join("reasons", "; ").alias("reasons"), "stage")
