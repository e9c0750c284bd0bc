"""Data-quality checks. Every check returns a findings table
``(check, column, row_key, detail)``; a gate counts it. Checks are one pass over the
data each (all columns at once), never one scan per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINDINGS = "check string, column string, row_key string, detail string"

# The columns the final table must hold, and its price columns.
REQUIRED_COLUMNS = ("date", "mean_sentiment_score", "nasdaq", "sp500", "dj30", "crude_oil", "gold",
                    "usd_inr", "10yb", "vix", "nsebank", "nsei")
PRICE_COLUMNS = ("nasdaq", "sp500", "dj30", "crude_oil", "gold", "usd_inr", "10yb", "vix", "nsebank", "nsei")


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _finding(check: str, column, row_key, detail) -> list[Column]:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return [F.lit(check).alias("check"), lit(column).cast("string").alias("column"),
            lit(row_key).cast("string").alias("row_key"), lit(detail).cast("string").alias("detail")]


def _unpivot(df: DataFrame, key: str, cols: Sequence[str], as_string: bool = False) -> DataFrame:
    vals = [(_q(c).cast("string") if as_string else _q(c).cast("double")) for c in cols]
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in zip(cols, vals)]))
    return df.select(_q(key).cast("string").alias("row_key"), st.alias("__u")).select(
        "row_key", F.col("__u.column").alias("column"), F.col("__u.value").alias("value"))


def check_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """DQ-01: required columns that are missing (schema metadata only)."""
    spark = df.sparkSession
    missing = [c for c in required if c not in set(df.columns)]
    return spark.createDataFrame([("missing_column", c, None, None) for c in missing], FINDINGS)


def check_dtypes(df: DataFrame, key: str, date_cols: Sequence[str] = ("date",),
                 numeric_cols: Sequence[str] | None = None) -> DataFrame:
    """DQ-02: cells that hold text but do not parse as a date / number."""
    from ..functions.dates import parse_date_coerce
    numeric_cols = [c for c in (numeric_cols if numeric_cols is not None else df.columns)
                    if c not in list(date_cols) + [key]]
    parts = []
    if date_cols:
        u = _unpivot(df, key, date_cols, as_string=True)
        parts.append(u.filter(F.col("value").isNotNull() & parse_date_coerce(F.col("value")).isNull())
                     .select(*_finding("bad_date", F.col("column"), F.col("row_key"), F.col("value"))))
    if numeric_cols:
        u = _unpivot(df, key, numeric_cols, as_string=True)
        parts.append(u.filter(F.col("value").isNotNull() & F.trim(F.col("value")).try_cast("double").isNull())
                     .select(*_finding("bad_number", F.col("column"), F.col("row_key"), F.col("value"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_ratio_columns(df: DataFrame) -> DataFrame:
    """AGG-04: null fraction per column, one aggregate pass."""
    return df.agg(*[F.avg(_q(c).isNull().cast("double")).alias(c) for c in df.columns])


def missing_ratio_rows(df: DataFrame, cols: Sequence[str] | None = None, name: str = "missing_ratio"
                       ) -> DataFrame:
    """AGG-05: null fraction per row."""
    cols = list(cols or df.columns)
    nulls = F.aggregate(F.array(*[_q(c).isNull().cast("int") for c in cols]), F.lit(0), lambda a, x: a + x)
    return df.withColumn(name, nulls / F.lit(float(len(cols))))


def check_missing(df: DataFrame, key: str, threshold: float = 0.4) -> tuple[DataFrame, DataFrame]:
    """DQ-03: drop columns with null ratio >= threshold, then rows with ratio >= threshold,
    then report rows still holding nulls. Returns (findings, cleaned table).
    The column decision reads a one-row summary (one value per column) on the driver."""
    ratios = missing_ratio_columns(df).first().asDict()
    drop = [c for c, r in ratios.items() if c != key and r is not None and r >= threshold]
    spark = df.sparkSession
    col_f = spark.createDataFrame([("column_missing", c, None, f"{ratios[c]:.4f}") for c in drop], FINDINGS)
    kept = df.drop(*drop)
    value_cols = [c for c in kept.columns]
    scored = missing_ratio_rows(kept, value_cols, "__r")
    row_f = scored.filter(F.col("__r") >= threshold).select(
        *_finding("row_missing", None, _q(key), F.format_number("__r", 4)))
    cleaned = scored.filter(F.col("__r") < threshold).drop("__r")
    left = cleaned.filter(F.exists(F.array(*[_q(c).isNull() for c in value_cols]), lambda x: x)).select(
        *_finding("null_left", None, _q(key), None))
    return col_f.unionByName(row_f).unionByName(left), cleaned


def check_ranges(df: DataFrame, key: str, score: str = "mean_sentiment_score",
                 prices: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """DQ-04: score outside [-1, 1]; any price below 0."""
    prices = [c for c in prices if c in df.columns]
    s = df.filter((_q(score) < -1) | (_q(score) > 1)).select(
        *_finding("score_range", score, _q(key), _q(score)))
    u = _unpivot(df, key, prices).filter(F.col("value") < 0)
    p = u.select(*_finding("negative_price", F.col("column"), F.col("row_key"), F.col("value")))
    return s.unionByName(p)


def check_duplicates(df: DataFrame) -> DataFrame:
    """DQ-05: full-row duplicates beyond the first copy; one finding per duplicated row
    content with the number of extra copies (aggregated map-side, skew-safe)."""
    cols = df.columns
    g = df.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    key = F.concat_ws("|", *[_q(c).cast("string") for c in cols])
    return g.select(*_finding("duplicate_row", None, key, (F.col("__n") - 1)))


def check_future_dates(df: DataFrame, date: str = "date", as_of=None, key: str | None = None) -> DataFrame:
    """DQ-06: dates after ``as_of`` (today when not given); detail is the ISO text."""
    now = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    d = F.coalesce(_q(date).cast("string").try_cast("timestamp"), F.try_to_timestamp(_q(date).cast("string")))
    return df.filter(d > now).select(*_finding("future_date", date, _q(key or date),
                                               F.date_format(d, "yyyy-MM-dd HH:mm:ss")))


def run_all_checks(df: DataFrame, key: str = "date", required: Sequence[str] = REQUIRED_COLUMNS,
                   score: str = "mean_sentiment_score", prices: Sequence[str] = PRICE_COLUMNS,
                   as_of=None, fail_on_error: bool = False) -> DataFrame:
    """DQ-07: rows with any null are dropped first (as the reference does), then the six
    checks in order; the union of findings. ``fail_on_error`` raises when any exist."""
    d = df.na.drop("any")
    parts = [check_columns(d, required)]
    num = [c for c in d.columns if c not in (key,)]
    parts.append(check_dtypes(d, key, [key], num))
    findings, _ = check_missing(d, key)
    parts.append(findings)
    parts.append(check_ranges(d, key, score, prices))
    parts.append(check_duplicates(d))
    parts.append(check_future_dates(d, key, as_of))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if fail_on_error and not out.isEmpty():
        raise ValueError("data validation failed")
    return out
