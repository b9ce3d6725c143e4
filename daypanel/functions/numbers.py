"""Exact arithmetic on scaled whole numbers, and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_quotient(total: Column, count: Column) -> Column:
    """``total / count`` of longs, rounded half away from zero; null when there is nothing to divide by.

    Twice the total must fit into 64 bits.
    """
    n = F.nullif(count.cast("bigint"), F.lit(0).cast("bigint"))
    return F.call_function("div", total * 2 + F.when(total >= 0, n).otherwise(-n), n * 2)


def bucket_hash(key: Column) -> Column:
    """Eight hex digits of md5 as a whole number below 2**32: stable across engines, runs and retries."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps."""
    span = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span).cast("bigint")


def age_years(admitted: Column, born: Column) -> Column:
    return whole_days(admitted, born).cast("double") / F.lit(365.28)
