"""Guarded ratios used for shares and indexes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom in the type of the columns (decimals stay decimals); null when the bottom is null or zero."""
    return F.try_divide(top, bottom)


def share(value: Column, total: Column) -> Column:
    """Percentage of a total, null when the total is zero; nothing is rounded."""
    return ratio(value, total) * 100


def index(current: Column, base: Column, scale: Column | None = None, base_scale: Column | None = None) -> Column:
    """Percent change of `current` against `base`; the scales bring both sides to the same length."""

    def scaled(side: Column, factor: Column | None) -> Column:
        return side if factor is None else side * factor

    return ratio(scaled(current, scale) - scaled(base, base_scale), base) * 100
