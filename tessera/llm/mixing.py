"""Mixing sources to target weights by Poisson replication, with built-in functions only.

Source s with n_s rows and target share w_s of an output of T rows is repeated at the rate
w_s * T / n_s. Each row draws its number of copies by inverting the Poisson distribution of that
mean at a uniform number hashed from the seed and its id, is exploded by that number, and
all copies are shuffled by a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: means above this are drawn as a sum of equal parts, since exp(-mean) would vanish
LARGEST_PART = 64.0


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5 over seed and columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column, terms: Column) -> Column:
    """[P(X <= 0), P(X <= 1), ...] with ``terms`` + 1 entries, by the recurrence of the terms."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def step(acc: Column, j: Column) -> Column:
        p = acc["p"] * mean / j
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda acc: acc["cdf"])


def source_rates(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5,
                 total: float = 1.0, source_col: str = "source") -> tuple[DataFrame, int]:
    """One row per source with its rate, number of parts and the CDF of one part; the number of sources.

    ``weights`` maps sources (None: null) to targets; sources it does not name get 0. Without it
    the target is the source's number of rows to the power ``temperature``. ``total`` is
    the output's expected size over the input's. The counts are taken over all rows."""
    counts = docs.groupBy(F.col(source_col).alias("_source")).agg(F.count(F.lit(1)).alias("_rows"))
    if weights is None:
        target = F.pow(F.col("_rows").cast("double"), F.lit(float(temperature)))
    else:
        target = F.lit(0.0)
        for name, weight in weights.items():
            same = F.col("_source").isNull() if name is None else F.col("_source") == F.lit(name)
            target = F.when(same, F.lit(float(weight))).otherwise(target)
    counts = materialize(counts.withColumn("_target", target), "source-counts")
    sums = counts.agg(F.sum("_rows"), F.sum("_target"), F.count(F.lit(1))).first()
    share = F.coalesce(F.try_divide(F.col("_target"), F.lit(float(sums[1] or 0))), F.lit(0.0))
    rate = F.round(share * F.lit(float(sums[0] or 0)) * F.lit(float(total)) / F.col("_rows"), 9)
    parts = F.greatest(F.lit(1), F.ceil(F.col("_rate") / F.lit(LARGEST_PART))).cast("int")
    mean = F.col("_rate") / F.col("_parts")
    terms = F.ceil(mean + 10 * F.sqrt(mean) + 20).cast("int")
    rates = (counts.withColumn("_rate", rate).withColumn("_parts", parts)
             .withColumn("_cdf", poisson_cdf(mean, terms)).select("_source", "_rate", "_parts", "_cdf"))
    return rates, sums[2]


def mix_sources(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5, total: float = 1.0,
                seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
                broadcast_sources: int = 10_000) -> DataFrame:
    """All columns of ``docs`` and ``mix_rate``, ``mix_copy`` (from 1) and ``mix_key`` (the order).

    Partitions hold random rows, each ordered by ``mix_key``. A null source is a source of its
    own. Rows with equal ids (null included) draw alike. An empty table gives an empty
    result; columns of the input named mix_rate, mix_copy or mix_key are replaced. The
    rates (a row per source) are broadcast if a count shows at most ``broadcast_sources`` of
    them; else Spark joins them by source and splits hot sources."""
    docs = docs.drop("mix_rate", "mix_copy", "mix_key")
    rates, sources = source_rates(docs, weights, temperature, total, source_col)
    if sources <= broadcast_sources:
        rates = F.broadcast(rates)
    draw = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")), F.lit(0),
        lambda n, j: n + F.size(F.filter("_cdf", lambda c: c <= uniform(seed, F.col(id_col), j))))
    copies = (docs.join(rates, docs[source_col].eqNullSafe(F.col("_source")))
              .withColumn("_n", draw).where(F.col("_n") > 0)
              .select(*docs.columns, F.col("_rate").alias("mix_rate"),
                      F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("mix_copy"))
              .withColumn("mix_key", uniform(seed + 1, F.col(id_col), F.col("mix_copy"))))
    return copies.repartition("mix_key", "mix_copy").sortWithinPartitions("mix_key", id_col, "mix_copy")


def mix_sql(temperature: float = 0.5, total: float = 1.0, seed: int = 17) -> str:
    """DuckDB text for ``mix_sources`` over ``documents`` with means below LARGEST_PART."""
    def u(seed: int, rest: str) -> str:
        return f"(('0x' || substr(md5('{seed}:' || {rest}), 1, 13))::BIGINT)::DOUBLE / {float(1 << 52)!r}"
    return f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
targets AS (SELECT source, n, pow(n::DOUBLE, {temperature!r}) AS t FROM counts),
rates AS (SELECT source, round(t / sum(t) OVER () * sum(n) OVER () * {total!r} / n, 9) AS rate FROM targets),
dist AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cdf FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM dist
  WHERE k < ceil(rate + 10 * sqrt(rate) + 20)),
cdfs AS (SELECT source, rate, list(cdf ORDER BY k) AS cdf FROM dist GROUP BY source, rate),
drawn AS (
  SELECT d.*, c.rate AS mix_rate,
         len(list_filter(c.cdf, lambda x: x <= {u(seed, "coalesce(d.doc_id::VARCHAR, '') || ':1'")})) AS n
  FROM documents d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source),
copies AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1))::INTEGER AS mix_copy FROM drawn WHERE n > 0)
SELECT *, {u(seed + 1, "coalesce(doc_id::VARCHAR, '') || ':' || mix_copy::VARCHAR")} AS mix_key FROM copies
"""
