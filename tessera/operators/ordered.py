"""Ordered (window) operators over keyed series, without single-partition windows.

Every operator takes ``keys`` (may be empty) and ``order`` (column name or list; the
first one drives the bucket, the rest break ties). Rows are windowed inside
``keys + [bucket(order)]``. By default buckets are cut by row count: the quantiles of the
ordering value split the table into stretches of about ``ROWS`` rows, and a value that alone
holds more is split by the second ordering column, so neither a dense month nor a hot
date ends in one task. What crosses a bucket edge is carried by a small per-bucket summary:

* lag / lead: local ``lag``/``lead``; the few rows at a bucket edge are fixed up from
  the edge rows of the neighbour buckets, matched by global position.
* back-fill: a running ``last(ignorenulls)`` in descending order (linear); the rest comes
  from the first non-null of the later buckets.
* running counts: local running sum plus the exclusive prefix sum of bucket totals.

Summaries have one row per (key, bucket). They are joined null-safely (a null key or a null
ordering value is a value of its own, nulls first), so adaptive execution broadcasts
them when they are small and shuffles them when they are not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BKT = "__bkt"
RN = "__rn"
CNT = "__cnt"
POS = "__pos"
START = "__start"
END = "__end"
TOTAL = "__total"

#: rows a bucket holds, and the most buckets that are cut (their bounds go to the driver)
ROWS = 100_000
MOST_BUCKETS = 10_000


def _as_list(x) -> list[str]:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def _number(df: DataFrame, order: str) -> Column | None:
    """The ordering value as a number that ascends with it; None for kinds without one."""
    dtype = df.schema[order].dataType
    if isinstance(dtype, T.DateType):
        return F.unix_date(order).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    if isinstance(dtype, T.NumericType):
        return F.col(order).cast("double")
    return None


def _sampled_cuts(df: DataFrame, value: Column, parts: int, rows: int) -> list:
    """``parts - 1`` cuts of any orderable value (text, binary, truth values), ascending, from about 20 sampled rows a part."""
    own = df.select(value.alias("v")).filter(F.col("v").isNotNull())
    sample = sorted(r["v"] for r in own.sample(min(1.0, 20 * parts / max(rows, 1)), seed=17).collect())
    return [sample[len(sample) * k // parts] for k in range(1, parts)] if sample else []


def _place(value: Column, bounds: list[float]) -> Column:
    """Number of ascending bounds at or below ``value``, in two short steps instead of one long one."""
    size = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i:i + size] for i in range(0, len(bounds), size)]
    heads = F.array(*(F.lit(p[0]) for p in parts))
    table = F.array(*(F.array(*map(F.lit, p)) for p in parts))
    part = F.size(F.filter(heads, lambda x: x <= value))
    inside = F.size(F.filter(F.try_element_at(table, part), lambda x: x <= value))
    return F.when(value.isNull() | (part == 0), 0).otherwise((part - 1) * size + inside)


def _quantiles(df: DataFrame, value: Column, parts: int) -> list[float]:
    got = df.agg(F.percentile_approx(value, F.array(*(F.lit(k / parts) for k in range(1, parts))), F.lit(50 * parts))).first()[0]
    return [x for x in got or [] if x == x]


def row_buckets(df: DataFrame, order, rows: int = ROWS) -> Column:
    """Bucket by row count, ascending with ``order``. Reads the ordering columns once (twice if a
    single value of the first one holds more than ``rows``); at most ``MOST_BUCKETS`` bounds
    come to the driver. Compute it once and hand it to several operators of one table."""
    order = _as_list(order)
    n = df.count()
    parts = min(MOST_BUCKETS, math.ceil(n / rows))
    if parts < 2:
        return F.lit(0)
    value = _number(df, order[0])
    if value is not None:
        cuts = _quantiles(df, value, parts)
    else:  # text is cut where its own order is, whatever it holds
        value = F.col(order[0])
        cuts = _sampled_cuts(df, value, parts, n)
    bounds = sorted(set(cuts))
    bucket = _place(value, bounds) if bounds else F.lit(0)
    hot = [x for x in bounds if cuts.count(x) > 1]
    if not hot or len(order) < 2:
        return bucket
    number = _number(df, order[1])
    second = F.col(order[1]) if number is None else number
    inner = F.lit(0)
    for x in hot:
        same, pieces = df.filter(value == x), cuts.count(x) + 1
        own = sorted(set(_quantiles(same, number, pieces) if number is not None else _sampled_cuts(same, second, pieces, pieces * rows)))
        if own:  # a hot value opens its bucket; what follows it there comes after all its parts
            later = [y for y in bounds if y > x]
            behind = value > x if not later else (value > x) & (value < later[0])
            inner = F.when(value == x, _place(second, own)).when(behind, MOST_BUCKETS).otherwise(inner)
    return bucket * (MOST_BUCKETS + 1) + inner


def bucket_column(df: DataFrame, order, bucket=None) -> Column:
    """Bucket of the ordering value. ``bucket`` is None (by row count), a Column, a date granularity
    ('year', 'quarter', 'month', 'week', 'day', 'hour') or, for numeric orders, a width."""
    if isinstance(bucket, Column):
        return bucket
    if bucket is None:
        return row_buckets(df, order)
    first = _as_list(order)[0]
    dtype = df.schema[first].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc(bucket, F.col(first))
    if isinstance(dtype, T.StringType):
        return F.date_trunc(bucket, F.try_to_timestamp(F.col(first)))
    return F.floor(F.col(first) / F.lit(bucket))


def with_bucket(df: DataFrame, order, bucket=None) -> DataFrame:
    if BKT in df.columns:
        return df
    return df.withColumn(BKT, bucket_column(df, order, bucket))


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join by columns where null equals null; the right side's columns of that name go."""
    other = right.select(*[F.col(c).alias(f"__on{i}") for i, c in enumerate(on)], *[c for c in right.columns if c not in on])
    cond = F.lit(True)
    for i, c in enumerate(on):
        cond = cond & F.col(c).eqNullSafe(F.col(f"__on{i}"))
    return left.join(other, cond, how).drop(*[f"__on{i}" for i in range(len(on))])


def _local_window(keys, order):
    return Window.partitionBy(*keys, BKT).orderBy(*order)


def _drop_helpers(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    helpers = [c for c in (BKT, RN, CNT, POS, START, END, TOTAL) if c in df.columns and c not in keep]
    return df.drop(*helpers)


def _starts(windowed: DataFrame, keys: Sequence[str], with_total: bool = False) -> DataFrame:
    """One row per (key, bucket) with the 1-based global position of the bucket's first
    row (and the key's total). Read from rows already windowed by (key, bucket), so no
    extra aggregation exchange: the first row of a bucket carries the bucket size."""
    keys = list(keys)
    firsts = windowed.filter(F.col(RN) == 1).select(*keys, BKT, CNT)
    run = Window.partitionBy(*keys).orderBy(BKT).rowsBetween(Window.unboundedPreceding, 0)
    out = firsts.withColumn(START, F.sum(CNT).over(run) - F.col(CNT) + 1)
    if with_total:
        out = out.withColumn(TOTAL, F.sum(CNT).over(Window.partitionBy(*keys)))
    return out.drop(CNT)


def _numbered(df: DataFrame, keys, order, bucket, extra: dict | None = None) -> DataFrame:
    d = with_bucket(df, order, bucket)
    lw = _local_window(keys, order)
    return d.withColumns({RN: F.row_number().over(lw),
                         CNT: F.count(F.lit(1)).over(Window.partitionBy(*keys, BKT)),
                         **(extra or {})})


def positions(df: DataFrame, keys=(), order="date", bucket=None,
              with_total: bool = False) -> DataFrame:
    """Adds ``__pos``: 1-based row number within the key in ``order`` (and ``__total``)."""
    keys, order = _as_list(keys), _as_list(order)
    src = [c for c in df.columns if c != BKT]
    d1 = _numbered(df, keys, order, bucket)
    out = (_join(d1, _starts(d1, keys, with_total), keys + [BKT])
           .withColumn(POS, (F.col(START) + F.col(RN) - 1).cast("long")))
    return out.select(*src, POS, *([TOTAL] if with_total else []))


def shift(df: DataFrame, specs: dict[str, tuple[str, int]], keys=(), order="date",
          bucket=None) -> DataFrame:
    """Adds one column per spec ``name -> (source, k)``: the source value k rows before
    (k > 0, lag) or -k rows after (k < 0, lead), per key in ``order``.

    Inside a bucket this is a plain ``lag``/``lead``. Rows within k of a bucket edge
    read across it: the few edge rows of every bucket get global positions and a
    range-frame window over just those rows (per key) finds the value k positions away.
    """
    keys, order = _as_list(keys), _as_list(order)
    if not specs:
        return df
    src_cols = [c for c in df.columns if c != BKT]
    part = keys + [BKT]
    lw = _local_window(keys, order)
    local = {name: (F.lag(src, k).over(lw) if k > 0 else F.lead(src, -k).over(lw))
             for name, (src, k) in specs.items()}
    nlag = max([k for _, k in specs.values() if k > 0], default=0)
    nlead = max([-k for _, k in specs.values() if k < 0], default=0)
    d1 = _numbered(df, keys, order, bucket, local)
    edge = (F.col(RN) <= nlag) | (F.col(RN) > F.col(CNT) - nlead)
    source = (F.col(RN) > F.col(CNT) - nlag) | (F.col(RN) <= nlead)

    def crosses(k):
        return (F.col(RN) <= k) if k > 0 else (F.col(RN) > F.col(CNT) + k)

    small = (_join(d1.filter(edge | source), _starts(d1, keys), part)
             .withColumn(POS, F.col(START) + F.col(RN) - 1))
    pw = Window.partitionBy(*keys).orderBy(POS)
    fixed = small.withColumns({
        name: F.when(crosses(k), F.first(F.col(src)).over(pw.rangeBetween(-k, -k))).otherwise(F.col(name))
        for name, (src, k) in specs.items()}).filter(edge)
    out_cols = src_cols + [n for n in specs if n not in src_cols]
    return d1.filter(~edge).select(*out_cols).unionByName(fixed.select(*out_cols))


def lag(df, col, k=1, name=None, keys=(), order="date", bucket=None):
    return shift(df, {name or f"{col}_lag{k}": (col, k)}, keys, order, bucket)


def lead(df, col, k=1, name=None, keys=(), order="date", bucket=None):
    return shift(df, {name or f"{col}_lead{k}": (col, -k)}, keys, order, bucket)


def backfill(df: DataFrame, cols: Sequence[str] | None = None, keys=(), order="date",
             bucket=None) -> DataFrame:
    """WIN-04: a null takes the next non-null value in ``order``; trailing nulls stay.
    The first row of each bucket, after the local fill, holds the bucket's first
    non-null; later buckets pass it back through a window over those rows only."""
    keys, order = _as_list(keys), _as_list(order)
    cols = [c for c in (cols or df.columns) if c not in keys + order + [BKT]]
    src_cols = [c for c in df.columns if c != BKT]
    part = keys + [BKT]
    down = [F.col(c).desc_nulls_last() for c in order]
    after = Window.partitionBy(*part).orderBy(*down).rowsBetween(Window.unboundedPreceding, 0)
    local = with_bucket(df, order, bucket).withColumns({
        RN: F.row_number().over(Window.partitionBy(*part).orderBy(*down)), CNT: F.count(F.lit(1)).over(Window.partitionBy(*part)),
        **{c: F.last(c, ignorenulls=True).over(after) for c in cols}})
    later = Window.partitionBy(*keys).orderBy(F.col(BKT).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    carry = local.filter(F.col(RN) == F.col(CNT)).select(
        *part, *[F.last(c, ignorenulls=True).over(later).alias(f"__n{i}") for i, c in enumerate(cols)])
    out = _join(local, carry, part).withColumns(
        {c: F.coalesce(F.col(c), F.col(f"__n{i}")) for i, c in enumerate(cols)})
    return out.select(*src_cols)


def running_count(df: DataFrame, cond: Column, name: str, keys=(), order="date",
                  inclusive: bool = False, bucket=None) -> DataFrame:
    """Number of earlier rows (``inclusive`` adds the current one) of the key where
    ``cond`` holds; a prefix count carried across buckets."""
    keys, order = _as_list(keys), _as_list(order)
    src_cols = [c for c in df.columns if c != BKT]
    hit = F.coalesce(cond.cast("long"), F.lit(0))
    part = keys + [BKT]
    upto = _local_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    d1 = _numbered(df.withColumn("__hit", hit), keys, order, bucket,
                   {"__incl": F.sum("__hit").over(upto)})
    before = Window.partitionBy(*keys).orderBy(BKT).rowsBetween(Window.unboundedPreceding, -1)
    carry = (d1.filter(F.col(RN) == F.col(CNT))
             .select(*part, F.coalesce(F.sum("__incl").over(before), F.lit(0)).alias("__carry")))
    own = F.col("__incl") if inclusive else F.col("__incl") - F.col("__hit")
    out = (_join(d1, carry, part)
           .withColumn(name, (own + F.col("__carry")).cast("long")))
    return out.select(*src_cols, name)


# ---------------------------------------------------------------- named operators

def pct_change(df: DataFrame, cols: Sequence[str], keys=(), order="date", suffix="_pct_chg",
               bucket=None) -> DataFrame:
    """WIN-01: ``(x / previous - 1) * 100`` per column; division by zero gives null."""
    prev = {f"__prev_{c}": (c, 1) for c in cols}
    out = shift(df, prev, keys, order, bucket)
    return out.withColumns({
        f"{c}{suffix}": (F.try_divide(F.col(c), F.col(f"__prev_{c}")) - 1) * 100 for c in cols
    }).drop(*prev)


def log_return(df: DataFrame, col: str, name: str | None = None, keys=(), order="date",
               bucket=None) -> DataFrame:
    """WIN-03: ``ln(x / previous)``; non-positive ratios give null."""
    name = name or f"{col}_log_ret"
    out = shift(df, {"__prev": (col, 1)}, keys, order, bucket)
    ratio = F.try_divide(F.col(col), F.col("__prev"))
    return out.withColumn(name, F.when(ratio > 0, F.ln(ratio))).drop("__prev")


def difference(df: DataFrame, col: str, name: str | None = None, keys=(), order="date",
               bucket=None) -> DataFrame:
    """WIN-09: first difference."""
    name = name or f"{col}_diff"
    out = shift(df, {"__prev": (col, 1)}, keys, order, bucket)
    return out.withColumn(name, F.col(col) - F.col("__prev")).drop("__prev")


def lead_target(df: DataFrame, source: str, target: str = "target", keys=(), order="date",
                bucket=None) -> DataFrame:
    """WIN-02: target = next row's source; the last row keeps a null target."""
    return shift(df, {target: (source, -1)}, keys, order, bucket)


def lag_matrix(df: DataFrame, col: str, p: int, keys=(), order="date", prefix=None,
               bucket=None) -> DataFrame:
    """WIN-08: p lags of a series as columns ``<col>_lag1..p``."""
    prefix = prefix or f"{col}_lag"
    return shift(df, {f"{prefix}{i}": (col, i) for i in range(1, p + 1)}, keys, order, bucket)


def row_index(df: DataFrame, name: str = "row_index", keys=(), order="date",
              bucket=None) -> DataFrame:
    """WIN-06: 1-based row number in order, per key, without a single-partition window."""
    return positions(df, keys, order, bucket).withColumnRenamed(POS, name)


def chronological_split(df: DataFrame, keys=(), order="date", ratios=(0.6, 0.2, 0.2),
                        name: str = "split", bucket=None) -> DataFrame:
    """WIN-07: first ``int(n*r0)`` rows train, next ``int(n*r1)`` val, the rest test."""
    if abs(sum(ratios) - 1.0) > 1e-5:
        raise ValueError(f"split ratios must sum to 1, got {ratios}")
    r_train, r_val = float(ratios[0]), float(ratios[1])
    d = positions(df, keys, order, bucket, with_total=True)
    n_train = F.floor(F.col(TOTAL) * F.lit(r_train))
    n_val = F.floor(F.col(TOTAL) * F.lit(r_val))
    split = (F.when(F.col(POS) <= n_train, "train")
             .when(F.col(POS) <= n_train + n_val, "val").otherwise("test"))
    return d.withColumn(name, split).drop(POS, TOTAL)


def gap_segment_average(df: DataFrame, score: str, price: str, name: str | None = None,
                        keys=(), order="date", bucket=None) -> DataFrame:
    """WIN-05: a run of rows without ``price`` plus the next priced row forms one segment;
    each row takes the segment's null-skipping mean ``score``. A trailing run without a
    price is its own segment; a priced row after a priced row is a segment of one."""
    keys = _as_list(keys)
    name = name or score
    seg = running_count(df, F.col(price).isNotNull(), "__seg", keys, order, inclusive=False, bucket=bucket)
    means = seg.groupBy(*keys, "__seg").agg(F.avg(score).alias("__mean"))
    out = _join(seg, means, keys + ["__seg"]).withColumn(name, F.col("__mean"))
    cols = [c for c in df.columns if c != BKT] + ([name] if name not in df.columns else [])
    return out.select(*cols)


def sequence_windows(df: DataFrame, col: str, length: int = 10, name: str = "window",
                     keys=(), order="date", bucket=None) -> DataFrame:
    """WIN-10: look-back windows of ``length`` values (oldest first), kept only when full."""
    specs = {f"__w{i}": (col, i) for i in range(1, length)}
    out = shift(df, specs, keys, order, bucket)
    arr = F.array(*[F.col(f"__w{i}") for i in range(length - 1, 0, -1)], F.col(col))
    out = out.withColumn(name, F.filter(arr, lambda x: x.isNotNull())).drop(*specs)
    return out.filter(F.size(name) == length)
