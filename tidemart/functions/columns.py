"""Small conversions shared by the column helpers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Union[Column, str, int, float]
AsOf = Union[Column, date, str]


def as_col(value: ColumnLike) -> Column:
    """Column names become columns, numbers become literals."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def as_day(as_of: AsOf) -> Column:
    """The reporting day as a date column: a literal, or a scalar subquery."""
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(as_of).cast("date")


def null_as_zero(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Replace nulls in numeric columns with 0."""
    return df.na.fill(0, subset=list(columns) if columns is not None else None)


def join_null_safe(
    rows: DataFrame, other: DataFrame, keys: Iterable[str], hint: str | None = None
) -> DataFrame:
    """Inner join on keys where null equals null, so rows with a null key stay."""
    keys = list(keys)
    renamed = other.select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[c for c in other.columns if c not in keys]
    )
    if hint:
        renamed = renamed.hint(hint)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(renamed, same).drop(*[f"__{k}" for k in keys])


def with_one_row(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (totals, limits) to every row.

    The row is a scalar subquery: computed once, and an error if it is not one row.
    """
    packed = one_row.select(F.struct(*one_row.columns)).scalar()
    return (
        rows.withColumn("__one", packed)
        .withColumns({c: F.col(f"__one.{c}") for c in one_row.columns})
        .drop("__one")
    )


def join_small_classes(rows: DataFrame, classes: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Attach one row per class to the rows of the class.

    No hint is given: adaptive execution broadcasts the classes after measuring
    them, and otherwise splits a hot class.
    """
    keys = list(keys)
    return join_null_safe(rows, classes, keys) if keys else with_one_row(rows, classes)
