"""Filters as the reports use them. A null operand never passes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_list(col: Column, values: Sequence[object]) -> Column:
    return col.isin(*values)


def not_in(col: Column, values: Sequence[object]) -> Column:
    return ~col.isin(*values)


def known(col: Column, junk: Sequence[str]) -> Column:
    """Neither null nor one of the placeholder values."""
    return col.isNotNull() & ~col.isin(*junk)


def date_range(col: Column, start: str | dt.date, end: str | dt.date) -> Column:
    """Half-open [start, end). Literal dates, so it reaches partition and row-group pruning."""
    return (col >= _date(start)) & (col < _date(end))


def in_year(col: Column, year: int) -> Column:
    """A year as a date range on the bare column: unlike year(col) = y this one is pushed down."""
    return date_range(col, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def dated(df: DataFrame, col: str, start: str | dt.date, end: str | dt.date) -> Column:
    """`date_range` on a table's date column that also prunes its year partitions.

    Prod tables are laid out by the year of that date, which the date predicate alone cannot use.
    """
    rows = date_range(F.col(col), start, end)
    if "year" not in df.columns:
        return rows
    last_day = _day(end) - dt.timedelta(days=1)
    return F.col("year").between(_day(start).year, last_day.year) & rows


def dated_in_year(df: DataFrame, col: str, year: int) -> Column:
    return dated(df, col, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def like(col: Column, pattern: str) -> Column:
    return col.like(pattern)


def between(col: Column, low: object, high: object) -> Column:
    return col.between(low, high)


def ntz(value: dt.datetime) -> Column:
    """Wall-clock literal. A plain datetime literal carries a zone and would drag the compared
    column through a time-zone cast, which also stops it from being pushed down."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _date(value: str | dt.date) -> Column:
    return F.lit(_day(value))
