"""Distinct collisions kept at their finest grain, month by month, and counted by month, year and over all."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import in_list, known
from ..operators.distinct import distinct_words, word_counts
from ..sources.tables import Lake
from .model import Model
from .reports import INJURED_STATES, TURNING, UNTOLD_INJURIES

LAYER = "rollups"
MONTH = "month_start"
UNITS = ("month", "year", "all")


def injured(persons: DataFrame) -> DataFrame:
    """The rows that Q5 counts."""
    return persons.filter(
        in_list(F.col("emotional_status"), INJURED_STATES) & known(F.col("bodily_injury"), UNTOLD_INJURIES)
    )


def turning(model: Model) -> DataFrame:
    """Collision and date of the model rows that Q10 counts."""
    wanted = in_list(F.col("high_impact_crash"), ["Yes"]) & in_list(F.col("pre_crash"), TURNING)
    return model.counted("collision_id", "crash_date", vehicles_where=wanted)


def keep_distinct(
    lake: Lake,
    name: str,
    rows: DataFrame,
    keys: Sequence[str],
    id_col: str = "collision_id",
    date_col: str = "crash_date",
    months: Sequence[dt.date] | None = None,
) -> None:
    """Keep the ids of every group and month; with `months` (first days) only these are read and replaced.

    A month that has lost its rows is removed. Rows without a date are a month of their own, renewed by a
    full run alone. Months must be whole: give all rows of a month, not those of one load. A table that holds bitmaps, as
    earlier versions kept them, needs a full run first.
    """
    month = F.trunc(F.col(date_col).cast("date"), "month")
    if months is not None:
        months = sorted(set(months))
        start = F.col(date_col).cast("date")
        within = [(start >= F.lit(first)) & (start < F.lit(after)) for first, after in _ranges(months)]
        rows = rows.where(reduce(lambda a, b: a | b, within, F.lit(False)))
    words = distinct_words(rows, [*keys, month.alias(MONTH)], id_col)
    # Which months still have rows is counted by the write itself.
    by_month = [F.count(F.when(F.col(MONTH) == F.lit(m), 1)).alias(f"_{i}") for i, m in enumerate(months or ())]
    found = lake.overwrite(words, LAYER, name, [MONTH], by_month, partitions_only=months is not None)
    for i, m in enumerate(months or ()):
        if not found[f"_{i}"]:
            lake.drop_partition(LAYER, name, MONTH, m.isoformat())


def _ranges(months: Sequence[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Sorted first days of months as ranges up to before another month; months in a row make one.

    The date may be a costly expression, which each comparison computes anew.
    """
    ranges: list[tuple[dt.date, dt.date]] = []
    for first in months:
        after = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
        if ranges and ranges[-1][1] == first:
            ranges[-1] = (ranges[-1][0], after)
        else:
            ranges.append((first, after))
    return ranges


def count_distinct(
    lake: Lake, name: str, keys: Sequence[str] = (), units: Sequence[str] = UNITS
) -> DataFrame:
    """(keys, unit, period, distinct_collisions) from the kept words alone, `keys` among those kept.

    The period is the first day of the month or year, null over all time and for rows without a date.
    """
    kept = lake.read_table(LAYER, name)
    parts = []
    for unit in units:
        period = F.lit(None).cast("date") if unit == "all" else F.trunc(MONTH, unit)
        counted = word_counts(kept, [*keys, period.alias("period")], "distinct_collisions")
        parts.append(counted.withColumn("unit", F.lit(unit)))
    return reduce(DataFrame.unionByName, parts)
