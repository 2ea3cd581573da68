"""Derived columns: decodes, buckets, flags and calendar parts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import between, like


def _chain(branches: Iterable[tuple[Column, object]], default: object) -> Column:
    """One CASE expression, first match wins; a null condition falls through to the default."""
    pairs = [(cond, value if isinstance(value, Column) else F.lit(value)) for cond, value in branches]
    default = default if isinstance(default, Column) else F.lit(default)
    if not pairs:
        return default
    (cond, value), *rest = pairs
    return reduce(lambda acc, b: acc.when(*b), rest, F.when(cond, value)).otherwise(default)


def decode(col: Column, mapping: Mapping[object, str], default: str) -> Column:
    """Look up a code by its text, so 1 and "1" match alike. Unknown codes and null give `default`."""
    key = col.cast("string")
    return _chain([(key == str(code), label) for code, label in mapping.items()], default)


def canonicalize(col: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """Canonical name of a case-insensitive alias; values in no alias list stay as they are."""
    low = F.lower(col)
    return _chain([(low.isin(*names), canon) for canon, names in aliases.items()], col)


def bucketize(
    col: Column,
    limits: Sequence[tuple[float, str]],
    default: str,
    null_label: str | None = None,
) -> Column:
    """Label of the first limit the value is below, else `default`.

    Null takes `null_label`, or the default when none is given.
    """
    nulls = [] if null_label is None else [(col.isNull(), null_label)]
    return _chain(nulls + [(col < limit, label) for limit, label in limits], default)


def slot(col: Column, ranges: Sequence[tuple[int, int, str]], default: str) -> Column:
    """Label of the closed range holding the value, else `default`."""
    return _chain([(between(col, lo, hi), label) for lo, hi, label in ranges], default)


def score(col: Column, rules: Sequence[tuple[str, int]], default: int) -> Column:
    """Ordinal score of the first LIKE pattern that matches."""
    return _chain([(like(col, pattern), points) for pattern, points in rules], default)


def is_yes(col: Column, yes: str = "Y") -> Column:
    """Y/N text to boolean; null stays null."""
    return col == yes


def is_positive(col: Column) -> Column:
    return F.coalesce(col > 0, F.lit(False))


def flag_in(col: Column, values: Sequence[str], yes: str = "Yes", no: str = "No") -> Column:
    return F.when(col.isin(*values), yes).otherwise(no)


def present(col: Column) -> Column:
    return col.isNotNull().cast("int")


def presence_sum(cols: Sequence[Column]) -> Column:
    return reduce(Column.__add__, [present(c) for c in cols])


def weekend_flag(col: Column, yes: str, no: str) -> Column:
    """Saturday or Sunday; null counts as a working day."""
    return F.when(F.dayofweek(col).isin(1, 7), yes).otherwise(no)


def age_in_years(as_of: dt.date | Column, year_col: Column) -> Column:
    """Calendar-year difference; `as_of` is passed in so that a rerun gives the same answer."""
    return F.year(as_of if isinstance(as_of, Column) else F.lit(as_of)) - year_col


def date_parts(df: DataFrame, col: str, parts: Mapping[str, str]) -> DataFrame:
    """Add calendar parts: {new column: year|month|day|hour|dayofweek}."""
    make = {
        "year": F.year, "month": F.month, "day": F.day, "hour": F.hour, "dayofweek": F.dayofweek,
    }
    return df.withColumns({name: make[part](F.col(col)) for name, part in parts.items()})


def period(col: Column, unit: str) -> Column:
    """First date of the year, month or week holding the value. Weeks start on Sunday."""
    day = col.cast("date")
    if unit == "week":
        return F.date_sub(day, F.dayofweek(day) - 1)
    if unit in ("year", "month"):
        return F.trunc(day, unit)
    raise ValueError(f"unsupported period {unit!r}")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, cut toward zero; negative when end comes first.

    Goes through the interval type, so it does not depend on the session time zone.
    """
    return (end - start).cast("interval minute").cast("bigint")
