"""String helpers for keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.columns import ColumnLike, as_col


def padded_key(prefix: str, value: ColumnLike, width: int) -> Column:
    """Prefix plus a zero-padded number, such as SUP007; longer numbers stay whole."""
    digits = as_col(value).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def sku(product_id: ColumnLike) -> Column:
    return F.concat(F.lit("SKU-"), F.upper(F.substring(as_col(product_id).cast("string"), 1, 8)))


def product_url(host: str, category: ColumnLike, product_id: ColumnLike) -> Column:
    return F.concat_ws("/", F.lit(host), F.lower(as_col(category)), as_col(product_id).cast("string"))


def last_char(value: ColumnLike) -> Column:
    return F.substring(as_col(value), -1, 1)


def status_from_event(event_type: ColumnLike) -> Column:
    """order_delivered -> delivered."""
    return F.regexp_replace(as_col(event_type), "^order_", "")


def month_label(value: ColumnLike) -> Column:
    return F.date_format(as_col(value), "yyyy-MM")


def uuid_text(digest: Column) -> Column:
    """32 hexadecimal digits in the groups of a uuid."""
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
