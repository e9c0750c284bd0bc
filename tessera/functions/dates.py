"""Date parsing, formatting and arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats the reference parses (Java pattern letters).
ARTICLE_DATE = "dd-MM-yyyy"                   # "Published 04-06-2025,"
HISTORY_DATE = "MMM d, yyyy"                  # "Jun 4, 2025"
ARTICLE_STAMP = "MMM d, yyyy h:mma 'IST'"     # "Jun 4, 2025 10:15AM IST"
ISO_DATE = "yyyy-MM-dd"
RUN_STAMP = "yyyyMMdd_HHmm"

# Formats tried, in order, by the coercing parser.
MIXED_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd",
                 "dd-MM-yyyy", "MM/dd/yyyy", "MMM d, yyyy", "d MMM yyyy")


def parse_date_strict(c: Column, fmt: str = ISO_DATE) -> Column:
    """CST-01: one format; a mismatch is an error (ANSI ``to_date`` raises)."""
    return F.to_date(c, fmt)


def published_date(text: Column) -> Column:
    """CST-01 / STX-08: second blank-separated word, commas removed, ``dd-MM-yyyy``."""
    word = F.regexp_replace(F.trim(F.try_element_at(F.split(F.trim(text), " "), F.lit(2))), ",", "")
    return F.try_to_timestamp(word, F.lit(ARTICLE_DATE)).cast("date")


def parse_date_coerce(c: Column, formats: Sequence[str] = MIXED_FORMATS) -> Column:
    """CST-02: an ISO stamp (fractions of a second and zone allowed), else the first format that
    parses; none gives null."""
    s = F.trim(c.cast("string"))
    stamp = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d"), F.try_to_timestamp(s))
    return F.coalesce(stamp, *[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("date")


def format_date(c: Column, fmt: str = ISO_DATE) -> Column:
    """CST-03."""
    return F.date_format(c, fmt)


def to_date_part(c: Column) -> Column:
    """CST-04 / SDT-03."""
    return F.to_date(c)


def shift_days(c: Column, days: int) -> Column:
    """SDT-01: +/- days."""
    return F.date_add(c, days)


def weekday(c: Column) -> Column:
    """SDT-02: Monday = 0 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(c)


def run_stamp(c: Column) -> Column:
    """SDT-04: ``yyyyMMdd_HHmm`` run name."""
    return F.date_format(c, RUN_STAMP)
