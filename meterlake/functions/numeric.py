"""Exact sums and guarded arithmetic.

Adding doubles gives a last digit that depends on row order, hence on partitioning and on
how a stream was cut into batches. Readings carry two decimals, so sums run on decimals and
come out the same in any order. NaN, the infinities and values too large for the decimal are
summed apart as doubles and added at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 2
PRECISION = 28
# Means are taken of measured values, which carry far fewer than ten decimals.
MEAN_SCALE = 10


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def as_exact(value: Column, scale: int = SCALE) -> Column:
    """Decimal form of a double, null for null, NaN, the infinities and values that don't fit."""
    return F.when(is_finite(value), value.try_cast(f"decimal({PRECISION},{scale})"))


def exact_sum(value: Column, scale: int = SCALE) -> Column:
    """``sum`` of a double column as an order-independent aggregate."""
    exact = as_exact(value, scale)
    finite = F.sum(exact).cast("double")
    special = F.sum(F.when(exact.isNull(), value))
    return F.coalesce(finite + special, special, finite)


def exact_mean(value: Column, scale: int = MEAN_SCALE) -> Column:
    """``avg`` of a double column as an order-independent aggregate."""
    known = F.count(value)
    return F.when(known > 0, exact_sum(value, scale) / known)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient where the denominator is positive, null elsewhere."""
    return F.when(denominator > 0, F.round(numerator / denominator, digits))


def count_where(predicate: Column | str) -> Column:
    """Rows for which the predicate is true (null counts as not true)."""
    return F.count_if(F.expr(predicate) if isinstance(predicate, str) else predicate)
