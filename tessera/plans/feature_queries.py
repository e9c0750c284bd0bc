"""Feature preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date_coerce
from ..operators import features as FE
from ..operators import ordered as O
from ..operators import project as PJ
from .fixtures import MAIN, SERIES, SQL_DAILY_ORDERS, SQL_HOURLY_PANEL, daily_orders, hourly_panel
from .registry import query, round_doubles, table

_P = f"WITH {SQL_HOURLY_PANEL}"


@query("impute_mean", f"""{_P} SELECT hour, {", ".join(f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {c}" for c in SERIES)}
FROM panel""")
def q_impute_mean(spark, sf):
    return round_doubles(FE.impute(hourly_panel(spark, sf), SERIES, "mean"))


@query("impute_median", f"""{_P} SELECT hour, {", ".join(f"round(coalesce({c}, quantile_cont({c}, 0.5) OVER ()), 6) AS {c}" for c in SERIES)}
FROM panel""")
def q_impute_median(spark, sf):
    return round_doubles(FE.impute(hourly_panel(spark, sf), SERIES, "median"))


_KNN_SQL = f"""{_P},
long AS (SELECT hour, j, v FROM (UNPIVOT panel ON {", ".join(SERIES)} INTO NAME j VALUE v)),
recv AS (SELECT hour FROM panel WHERE {" OR ".join(f"{c} IS NULL" for c in SERIES)}),
pd AS (SELECT r.hour, b.hour AS did, sum((a.v - b.v) * (a.v - b.v)) AS ss, count(*) AS nc
       FROM recv r JOIN long a ON a.hour = r.hour JOIN long b ON b.j = a.j AND b.hour <> r.hour GROUP BY 1, 2),
dist AS (SELECT hour, did, sqrt(5.0 / nc * ss) AS d FROM pd),
miss AS (SELECT r.hour, t.j FROM recv r CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in SERIES)}) t(j)
         WHERE NOT EXISTS (SELECT 1 FROM long l WHERE l.hour = r.hour AND l.j = t.j)),
cand AS (SELECT m.hour, m.j, dist.did, dist.d, l.v FROM miss m JOIN dist ON dist.hour = m.hour
         JOIN long l ON l.hour = dist.did AND l.j = m.j),
top AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY hour, j ORDER BY d, did) <= 5),
fill AS (SELECT hour, j, avg(v) AS f FROM top GROUP BY 1, 2)
SELECT p.hour, {", ".join(f"round(coalesce(p.{c}, f_{c}.f, avg(p.{c}) OVER ()), 6) AS {c}" for c in SERIES)}
FROM panel p {" ".join(f"LEFT JOIN fill f_{c} ON f_{c}.hour = p.hour AND f_{c}.j = '{c}'" for c in SERIES)}"""


@query("impute_knn", _KNN_SQL)
def q_impute_knn(spark, sf):
    return round_doubles(FE.impute_knn(hourly_panel(spark, sf), "hour", SERIES, k=5))


@query("impute_iterative")
def q_impute_iterative(spark, sf):
    return round_doubles(FE.impute_iterative(hourly_panel(spark, sf), SERIES))


@query("iqr_outlier_columns", """SELECT j AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
  round(q3 + 1.5 * (q3 - q1), 6) AS upper, coalesce(mn < q1 - 1.5 * (q3 - q1) OR mx > q3 + 1.5 * (q3 - q1), false) AS is_outlier
FROM (SELECT j, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, min(v) AS mn, max(v) AS mx
      FROM (UNPIVOT (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
            ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME j VALUE v) GROUP BY j)""")
def q_iqr_outlier_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    return round_doubles(FE.iqr_outlier_columns(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("log_transform", f"""{_P} SELECT hour, {", ".join(
    f"round(CASE WHEN (SELECT min({c}) FROM panel) > 0 THEN ln({c}) ELSE {c} END, 9) AS {c}" for c in SERIES)} FROM panel""")
def q_log_transform(spark, sf):
    out = FE.log_transform(hourly_panel(spark, sf), SERIES)
    return round_doubles(out, 9)


def _yj_sql(c, lam):
    return (f"CASE WHEN {c} >= 0 THEN (power({c} + 1, {lam}) - 1) / {lam} "
            f"ELSE -(power(1 - {c}, {2 - lam}) - 1) / {2 - lam} END")


@query("yeo_johnson", f"""SELECT l_orderkey, l_linenumber, round({_yj_sql("l_extendedprice", 0.5)}, 9) AS l_extendedprice,
  round({_yj_sql("(l_discount - 0.05)", 0.5)}, 9) AS l_discount FROM lineitem""")
def q_yeo_johnson(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                             (F.col("l_discount") - 0.05).alias("l_discount"))
    return round_doubles(FE.yeo_johnson(li, ["l_extendedprice", "l_discount"],
                                        {"l_extendedprice": 0.5, "l_discount": 0.5}), 9)


_OUT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "amount"]


@query("outlier_handle", """WITH li AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
  l_extendedprice, l_discount, l_extendedprice * l_quantity * l_quantity AS amount FROM lineitem),
st AS (SELECT """ + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3, min({c}) AS {c}_mn, max({c}) AS {c}_mx"
    for c in _OUT_COLS) + """ FROM li)
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"round(CASE WHEN ({c}_mn < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c}_mx > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)) "
    f"AND {c}_mn > 0 THEN ln({c}) ELSE {c} END, 6) AS {c}" for c in _OUT_COLS) + " FROM li, st")
def q_outlier_handle(spark, sf):
    """``amount`` has a long tail, so it is flagged and transformed; the others stay."""
    quantity = F.col("l_quantity").cast("double")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", quantity.alias("l_quantity"), "l_extendedprice", "l_discount",
                                             (F.col("l_extendedprice") * quantity * quantity).alias("amount"))
    return round_doubles(FE.outlier_handle(li, "log", 1.5, exclude=["l_orderkey", "l_linenumber"]), 6)


_SPLIT_SQL = """SELECT *, CASE WHEN rn <= floor(n * 0.6::DOUBLE) THEN 'train'
  WHEN rn <= floor(n * 0.6::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM daily)"""


@query("standard_scale", f"""WITH {SQL_DAILY_ORDERS}, s AS ({_SPLIT_SQL}),
st AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM s WHERE split = 'train')
SELECT date, split, round((value - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 9) AS value FROM s, st""")
def q_standard_scale(spark, sf):
    s = O.chronological_split(daily_orders(spark, sf), order="date")
    return round_doubles(FE.standard_scale(s, ["value"]), 9)


@query("robust_scale", f"""WITH {SQL_DAILY_ORDERS}, s AS ({_SPLIT_SQL}),
st AS (SELECT quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
       FROM s WHERE split = 'train')
SELECT date, split, round((value - med) / CASE WHEN iqr = 0 THEN 1 ELSE iqr END, 9) AS value FROM s, st""")
def q_robust_scale(spark, sf):
    s = O.chronological_split(daily_orders(spark, sf), order="date")
    return round_doubles(FE.robust_scale(s, ["value"]), 9)


def split_and_scale(df, order="date", target="target", keys=()):
    """SCL-03: chronological split, then standard scaling (fitted on train) of every
    numeric column except the target; one table with a ``split`` column."""
    s = O.chronological_split(df, keys=keys, order=order)
    return FE.standard_scale(s, None, exclude=[target])


@query("split_and_scale", f"""WITH {SQL_DAILY_ORDERS},
f AS (SELECT date, value, (value / lag(value) OVER (ORDER BY date) - 1) * 100 AS value_pct_chg,
      lead(value) OVER (ORDER BY date) AS target FROM daily),
s AS ({_SPLIT_SQL.replace("FROM daily", "FROM f")}),
st AS (SELECT avg(value) AS m1, stddev_pop(value) AS s1, avg(value_pct_chg) AS m2, stddev_pop(value_pct_chg) AS s2
       FROM s WHERE split = 'train')
SELECT date, split, round((value - m1) / s1, 9) AS value, round((value_pct_chg - m2) / s2, 9) AS value_pct_chg,
       target FROM s, st""")
def q_split_and_scale(spark, sf):
    d = O.shift(daily_orders(spark, sf), {"__p": ("value", 1), "target": ("value", -1)}, order="date")
    d = d.withColumn("value_pct_chg", (F.try_divide(F.col("value"), F.col("__p")) - 1) * 100).drop("__p")
    out = split_and_scale(d)
    return out.withColumns({c: F.round(c, 9) for c in ("value", "value_pct_chg")})


_SEL = [c for c in SERIES if c != MAIN]


@query("select_k_best", f"""{_P}, d AS (SELECT *, lead(purchase) OVER (ORDER BY hour) AS target FROM panel),
k AS (SELECT * FROM d WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _SEL + ["target"])}),
r AS (SELECT count(*) AS n, {", ".join(f"corr({c}, target) AS r_{c}" for c in _SEL)} FROM k),
l AS ({" UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, r_{c} AS r, n FROM r" for i, c in enumerate(_SEL))})
SELECT feature, round(r * r / (1 - r * r) * (n - 2), 6) AS f_score,
       row_number() OVER (ORDER BY r * r / (1 - r * r) * (n - 2) DESC, i) <= 2 AS selected FROM l""")
def q_select_k_best(spark, sf):
    d = O.lead_target(hourly_panel(spark, sf), MAIN, "target", order="hour")
    return round_doubles(FE.select_k_best(d, "target", k=2, cols=_SEL))


@query("variance_threshold", """SELECT feature, round(variance, 9) AS variance, coalesce(variance > 0.01, false) AS kept FROM (
  SELECT 'l_quantity' AS feature, var_pop(l_quantity) AS variance FROM lineitem
  UNION ALL SELECT 'l_extendedprice', var_pop(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', var_pop(l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', var_pop(l_tax) FROM lineitem)""")
def q_variance_threshold(spark, sf):
    li = table(spark, sf, "lineitem")
    v = FE.variances(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], threshold=0.01)
    return v.withColumn("variance", F.round("variance", 9))


_VAR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("variance_filter", f"""WITH li AS (SELECT l_orderkey, l_linenumber, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _VAR_COLS)} FROM lineitem),
l AS (UNPIVOT li ON {", ".join(_VAR_COLS)} INTO NAME feature VALUE value)
SELECT l_orderkey, l_linenumber, feature, value FROM l WHERE feature IN (SELECT feature FROM l GROUP BY feature HAVING var_pop(value) > 0.01)""")
def q_variance_filter(spark, sf):
    """The columns that the filter keeps, a row a value."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *(F.col(c).cast("double").alias(c) for c in _VAR_COLS))
    kept = FE.variance_threshold(li, 0.01, _VAR_COLS)
    return kept.unpivot(["l_orderkey", "l_linenumber"], [c for c in kept.columns if c in _VAR_COLS], "feature", "value")


@query("lda_projection")
def q_lda_projection(spark, sf):
    emb = table(spark, sf, "embeddings")
    return PJ.lda_projection(emb, "embedding", 64, "label", ["vec_id", "label"])


@query("kernel_pca")
def q_kernel_pca(spark, sf):
    emb = table(spark, sf, "embeddings")
    return PJ.kernel_pca(emb, "embedding", 64, "vec_id", ["vec_id"], n_components=5)


def preprocess_chain(df, order="hour", source=MAIN, target="target", impute_method="knn",
                     outlier_method="yeo", k=1.5):
    """PIP-01: dates parsed where they are text (rows without one go) -> distinct rows -> impute -> outlier transform
    -> returns, drop incomplete rows, next-row target; each step a DataFrame -> DataFrame function."""
    if isinstance(df.schema[order].dataType, T.StringType):
        df = df.withColumn(order, parse_date_coerce(F.col(order))).filter(F.col(order).isNotNull())
    d = df.dropDuplicates()
    num = [c for c in FE.numeric_columns(d) if c != target]
    if impute_method == "knn":
        d = FE.impute_knn(d, order, num)
    elif impute_method == "iterative":
        d = FE.impute_iterative(d, num)
    else:
        d = FE.impute(d, num, impute_method)
    d = d.checkpoint(eager=True)  # the outlier fit reads the imputed table several times
    d = FE.outlier_handle(d, outlier_method, k, exclude=[target])
    d = O.pct_change(d, num, order=order)
    d = d.na.drop("any")
    return O.lead_target(d, source, target, order=order)


@query("preprocess_chain")
def q_preprocess_chain(spark, sf):
    return round_doubles(preprocess_chain(hourly_panel(spark, sf)))
