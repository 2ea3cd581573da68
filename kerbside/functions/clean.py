"""Parsing, lenient casting and null filling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"


def fill_unknown(df: DataFrame, value: str = UNKNOWN) -> DataFrame:
    """Replace nulls in every string column. Run it last: derivations look at the nulls."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(value, subset=strings) if strings else df


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col.cast("string")) == "")


def cast_or_null(col: Column, to: str) -> Column:
    """Value cast to `to`; unparseable text becomes null instead of failing the job."""
    if to in ("timestamp", "timestamp_ntz"):
        return col.try_cast("timestamp_ntz")
    if to in ("int", "bigint"):
        # "3.0" is a whole number to the feeds that write it; the direct cast of that text is null.
        return F.coalesce(col.try_cast(to), col.try_cast("double").try_cast(to))
    return col.try_cast(to)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Cast the columns that exist, in one projection, and report the ones that do not."""
    missing = [name for name in types if name not in df.columns]
    cast = df.select(
        *[
            cast_or_null(F.col(name), types[name]).alias(name) if name in types else F.col(name)
            for name in df.columns
        ]
    )
    return cast, missing


def conform(
    df: DataFrame, types: Mapping[str, str], keep: Iterable[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Exactly the columns of `types`, cast leniently; missing ones come back as null and reported.

    `keep` names further columns that stay as they are.
    """
    cast, missing = cast_columns(df, types)
    filled = cast.withColumns({name: F.lit(None).cast(types[name]) for name in missing})
    return filled.select(*types, *keep), missing


def bad_value_counts(df: DataFrame, types: Mapping[str, str]) -> list[Column]:
    """Aggregates counting, per column, values that are present but do not parse as the type."""
    return [
        F.count(
            F.when(~is_blank(F.col(name)) & cast_or_null(F.col(name), to).isNull(), 1)
        ).alias(f"bad_{name}")
        for name, to in types.items()
        if name in df.columns
    ]


# The text forms of dates and times found in the feeds.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
MICROS_WITH_ZONE = "yyyy-MM-dd HH:mm:ss.SSSSSS z"
PLAIN_DATE = "yyyy-MM-dd"

DATE_PATTERNS = (ISO_SECONDS, ISO_MILLIS, MICROS_WITH_ZONE, PLAIN_DATE)


# A time of day at the end of the text, its hour captured: seconds, fraction and zone are optional.
TIME_OF_DAY = (
    r"(?:^|[ T])([01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?: ?(?:Z|UTC|[+-]\d\d:?\d\d))?$"
)


def parse_timestamp(col: Column, patterns: Iterable[str] = ()) -> Column:
    """Wall-clock timestamp from ISO-like text (a zone suffix is dropped), else from `patterns`.

    The ISO cast covers every pattern the feeds use and never shifts by the session time zone;
    `patterns` adds further layouts, tried in order. Text that fits none becomes null.
    """
    tries = [F.try_to_timestamp(col.cast("string"), F.lit(p)).cast("timestamp_ntz") for p in patterns]
    return F.coalesce(col.try_cast("timestamp_ntz"), *tries)


def parse_date(col: Column, patterns: Iterable[str] = ()) -> Column:
    return parse_timestamp(col, patterns).cast("date")


def clock_hour(col: Column) -> Column:
    """Hour of a time of day: "9:05", "13:45:10" or a full timestamp; anything else is null.

    One pattern instead of date parsing, which costs several times as much per row.
    """
    return F.regexp_extract(col.cast("string"), TIME_OF_DAY, 1).try_cast("int")


def first_number(col: Column) -> Column:
    """First unsigned number inside a text, null where there is none: "10.0 m asl" is 10.0."""
    return F.regexp_extract(col, r"\d+\.?\d*", 0).try_cast("double")


def rounded(col: Column, digits: int) -> Column:
    return F.round(col.try_cast("double"), digits)
