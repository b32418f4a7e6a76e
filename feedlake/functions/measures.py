"""Ratios and safe numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two digits; NULL unless ``whole`` is above zero."""
    return F.when(whole > 0, F.round(part / whole * 100, 2))


def real_or_null(value: Column) -> Column:
    """Double of any cell; NaN and text that is no number become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def whole_or_null(value: Column) -> Column:
    """64-bit int of any cell, cut towards zero; NaN, infinities and other text become NULL."""
    return real_or_null(value).try_cast("bigint")


def mean_of_pct(rate: Column) -> Column:
    """Mean of two-digit percentages, added up as decimals.

    A sum of doubles depends on the order of the rows, hence on partitioning and retries.
    """
    return F.try_divide(F.sum(rate.cast("decimal(18,2)")).cast("double"), F.count(rate))
