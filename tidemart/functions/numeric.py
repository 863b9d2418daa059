"""Null-safe arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.columns import ColumnLike, as_col

RATE_DIGITS = 2


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den as double; null when the denominator is zero or null."""
    return as_col(num).cast("double") / F.nullif(as_col(den).cast("double"), F.lit(0.0))


def safe_pct(num: ColumnLike, den: ColumnLike, digits: int = RATE_DIGITS) -> Column:
    """Rounded percentage that is null instead of failing on a zero denominator."""
    scaled = as_col(num).cast("double") * 100
    return F.round(ratio(scaled, den), digits)


def exact_mean(value: ColumnLike) -> Column:
    """Mean of a decimal column: exact decimal sum, one division at the end."""
    return ratio(F.sum(as_col(value)), F.count(as_col(value)))


def clip(value: ColumnLike, lower: ColumnLike, upper: ColumnLike) -> Column:
    """Limit a value to [lower, upper]; a null value stays null."""
    column = as_col(value)
    bounded = F.least(F.greatest(column, as_col(lower)), as_col(upper))
    return F.when(column.isNotNull(), bounded)


def non_negative(value: ColumnLike) -> Column:
    column = as_col(value)
    return F.when(column < 0, F.lit(0)).otherwise(column)
