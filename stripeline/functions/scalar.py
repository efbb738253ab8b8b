"""Scalar functions that queries over declared tables use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.month(day).cast("bigint")


def bucket_of(x: Column, low: int, high: int, n: int) -> Column:
    """0 below low, 1 to n in equal widths, n + 1 from high on."""
    return F.width_bucket(x.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n).cast("bigint"))


def rounded_average(x: Column, digits: int = 2) -> Column:
    """Average of whole numbers, rounded once, half away from zero: an average of decimals would be rounded to fewer digits before."""
    total, n = F.sum(x.cast("decimal(20,0)")), F.count(x)
    a, b = F.abs(total) * (2 * 10**digits) + n, n * 2
    return F.when(n > 0, F.sign(total) * ((a - a % b) / b).cast("double") / 10**digits)


def rendered(items: Column) -> Column:
    """{a,b} for a list."""
    return F.when(items.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", items.cast("array<string>")), F.lit("}")))
