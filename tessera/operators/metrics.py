"""Regression metrics by split in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       group: Sequence[str] = ("split",), n_features: int = 1) -> DataFrame:
    """RMSE, MAE, R2 and adjusted R2 = 1 - (1 - R2)(n - 1)/(n - p - 1) per group.
    R2 = 1 - SSE / SST with SST = n * var_pop(y). Rows without a label are skipped."""
    d = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    e = F.col(label) - F.col(prediction)
    agg = d.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("__sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("__sst"))
    r2 = 1 - F.try_divide(F.col("__sse"), F.col("__sst"))
    adj = 1 - (1 - F.col("r2")) * (F.col("n") - 1) / (F.col("n") - n_features - 1)
    return (agg.withColumn("r2", r2).withColumn("adjusted_r2", F.when(F.col("n") - n_features - 1 > 0, adj))
            .drop("__sse", "__sst"))
