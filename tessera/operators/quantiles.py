"""Exact quantiles without gathering a column, in a task or on the driver.

``percentile`` keeps every value of a group in one aggregation buffer. Here a sketch brackets each target rank, one pass counts
the values below each bracket, and the distinct values inside the brackets (a small share) are sorted into ranges with their
counts. Running totals over the ranges tell in which one a rank lies, and the value is picked there. Each pass covers all columns and
targets, as rows; what reaches the driver are the asked quantiles. Linear interpolation between the two
neighbouring ranks gives numpy's / ``percentile``'s definition."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import table_path

ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY
#: values of a column that need no bracket
SMALL = 1_000


def long_form(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``ci, x``: a row for each value, nulls and NaN left out."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    return df.select(F.posexplode(values).alias("ci", "x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))


def running_totals(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "until") -> DataFrame:
    """``df`` with the running total of ``value`` within ``keys`` in ``order`` (distinct within a key). Rows are sorted into
    ranges, written once; only the ranges' totals are added up by key."""
    spark = df.sparkSession
    keys = list(keys)
    path = table_path(spark, f"ranges-{uuid.uuid4().hex}")
    ranged = df.repartitionByRange(*keys, order).withColumn("__part", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*keys, "__part").agg(F.sum(value).alias("__sum"))
              .withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum"))
    inside = Window.partitionBy(*keys, "__part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("__in", F.sum(value).over(inside)).join(starts, [*keys, "__part"])
            .withColumn(name, F.col("__start") + F.col("__in")).drop("__start", "__in", "__part"))


def _pick(df: DataFrame, cols: Sequence[str], targets: list[tuple]) -> dict[tuple[int, int], tuple]:
    """For targets ``(ci, t, h, lo, hi)``: the values at ranks floor(h) and ceil(h); None where the bracket missed one."""
    spark = df.sparkSession
    asked = spark.createDataFrame(targets, "ci int, t int, h double, lo double, hi double")  # a row for each asked quantile
    near = long_form(df, cols).join(F.broadcast(asked), "ci").filter(F.col("x") <= F.col("hi"))
    # what lies below a bracket is one row (null, which sorts first); equal values are one row
    counted = near.groupBy("ci", "t", F.when(F.col("x") >= F.col("lo"), F.col("x")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(counted, ["ci", "t"], "v", "c").join(F.broadcast(asked), ["ci", "t"])
    holds = [(F.col("until") - F.col("c") <= r) & (r < F.col("until")) for r in (F.floor("h"), F.ceil("h"))]
    got = ranked.filter(holds[0] | holds[1]).groupBy("ci", "t").agg(*(
        F.max(F.when(x, F.col("v"))).alias(n) for n, x in zip(("a", "b"), holds))).collect()
    return {(r["ci"], r["t"]): (r["a"], r["b"]) for r in got}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], small: int = SMALL) -> dict[tuple[str, float], float | None]:
    """``{(column, p): quantile}`` with linear interpolation; None for an empty column. Nulls and NaN are left out. A column of
    at most ``small`` values is ranked whole, without a bracket."""
    cols, probs = list(cols), [float(p) for p in probs]
    edges = [(max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)) for p in probs]
    sketch = long_form(df, cols).groupBy("ci").agg(F.count(F.lit(1)).alias("n"), F.approx_percentile(
        "x", F.array(*[F.lit(e) for pair in edges for e in pair]), F.lit(ACCURACY)).alias("b")).collect()  # a row a column
    targets = []
    for r in sketch:
        for t, (p, (low, high)) in enumerate(zip(probs, edges)):
            whole = r["n"] <= small
            targets.append((r["ci"], t, (r["n"] - 1) * p, r["b"][2 * t] if low > 0 and not whole else float("-inf"),
                            r["b"][2 * t + 1] if high < 1 and not whole else float("inf")))
    found = _pick(df, cols, targets) if targets else {}
    missed = [(ci, t, h, float("-inf"), float("inf")) for ci, t, h, _, _ in targets if None in found.get((ci, t), (None,))]
    if missed:  # a bracket of the sketch that does not hold its rank: all values of that column
        found |= _pick(df, cols, missed)
    out: dict[tuple[str, float], float | None] = {(c, p): None for c in cols for p in probs}
    for ci, t, h, _, _ in targets:
        a, b = found[(ci, t)]
        out[(cols[ci], probs[t])] = a + (h - int(h)) * (b - a)
    return out
