"""Money and ratios: exact integers or decimals inside, doubles at the edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``numerator / denominator`` of integers, rounded half up; NULL over zero."""
    wide = "decimal(20,0)"
    return F.round(
        numerator.cast(wide) / F.nullif(denominator.cast(wide), F.lit(0).cast(wide)), scale
    ).cast("double")


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole)
