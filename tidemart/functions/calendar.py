"""Date and time arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf, ColumnLike, as_col, as_day

SECONDS_PER_DAY = 86400


def elapsed_days(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Fractional days between two timestamps."""
    seconds = F.unix_timestamp(as_col(later)) - F.unix_timestamp(as_col(earlier))
    return seconds.cast("double") / SECONDS_PER_DAY


def whole_days(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Complete days between two timestamps, rounded down."""
    return F.floor(elapsed_days(later, earlier)).cast("int")


def day_start(as_of: AsOf) -> Column:
    return as_day(as_of).cast("timestamp")


def month_start(value: ColumnLike) -> Column:
    return F.trunc(as_col(value).cast("date"), "month")


def week_start(value: ColumnLike) -> Column:
    """Monday of the ISO week."""
    return F.trunc(as_col(value).cast("date"), "week")


def months_apart(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Calendar months between two dates, ignoring the day of the month."""

    def index(value: ColumnLike) -> Column:
        return F.year(as_col(value)) * 12 + F.month(as_col(value))

    return (index(later) - index(earlier)).cast("int")


def weekday_monday0(value: ColumnLike) -> Column:
    return F.weekday(as_col(value))


def is_weekend(value: ColumnLike) -> Column:
    return F.weekday(as_col(value)).isin(5, 6)
