"""Numeric scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, digits: int = 2) -> Column:
    """CST-07: numpy-style rounding (half to even on the scaled binary value).
    ``rint(x * 10^d) / 10^d`` matches numpy where ``bround`` does not."""
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def parse_number(c: Column) -> Column:
    """CST-05: strip thousands separators, to double; bad text gives null."""
    return _try_double(F.regexp_replace(c, ",", ""))


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def to_numeric_coerce(c: Column) -> Column:
    """CST-06: non-numeric text becomes null."""
    return _try_double(F.trim(c.cast("string")))


def ln_exp(c: Column, inverse: bool = False) -> Column:
    """SMA-01: natural log (null for non-positive input) or exp."""
    return F.exp(c) if inverse else F.when(c > 0, F.ln(c))


def softmax(logits: Column) -> Column:
    """SMA-02: softmax over an array column (max-shifted for stability)."""
    mx = F.array_max(logits)
    ex = F.transform(logits, lambda x: F.exp(x - mx))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / tot)


def normal_draw(seed: int | None = None) -> Column:
    """SMA-03: one standard normal draw per row (seeded for repeatable runs)."""
    return F.randn(seed) if seed is not None else F.randn()


def rmse(err: Column) -> Column:
    """SMA-04 inside an aggregate."""
    return F.sqrt(F.avg(err * err))


def array_mean(arr: Column) -> Column:
    """SAR-01: null-skipping mean of an array; null when nothing is left."""
    vals = F.filter(arr, lambda x: x.isNotNull())
    n = F.size(vals)
    tot = F.aggregate(vals, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.when(n > 0, tot / n)


def nested_get(c: str, default=None) -> Column:
    """SNE-01: dotted path read with a default; a missing leaf gives the default."""
    return F.coalesce(F.col(c), F.lit(default)) if default is not None else F.col(c)
