"""Bands around the mean of a whole column (mean plus or minus one sample standard deviation)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """How to label one measure.

    `inclusive_top` picks what happens to the values that pass neither strict comparison: when set,
    anything not below mean+sd (null included) is `high`; otherwise anything neither below mean-sd
    nor above mean+sd (null included) is `middle`.
    """

    column: str
    output: str
    low: str
    middle: str
    high: str
    inclusive_top: bool = False


def band_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean_<c> and stddev_<c> (sample) of each column, in one pass."""
    aggregates = []
    for c in columns:
        aggregates += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"stddev_{c}")]
    return df.agg(*aggregates)


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per group n_<c>, mean_<c> and m2_<c> (the squared deviations summed): parts that `merged_stats` can put together."""
    aggregates = []
    for c in columns:
        n = F.count(c)
        aggregates += [
            n.alias(f"n_{c}"), F.avg(c).alias(f"mean_{c}"), (F.var_pop(c) * n).alias(f"m2_{c}")
        ]
    return df.groupBy(*by).agg(*aggregates)


def merged_stats(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As `band_stats` of all rows behind the parts, from their moments alone.

    The deviations of the parts' means are taken from the overall mean, not from zero, so nothing large cancels out.
    """
    means = parts.agg(*[
        F.try_divide(F.sum(F.col(f"n_{c}") * F.col(f"mean_{c}")), F.sum(f"n_{c}")).alias(c) for c in columns
    ])
    overall = means.select(F.struct(*columns).alias("means")).scalar()
    aggregates = []
    for c in columns:
        off = F.col(f"mean_{c}") - overall[c]
        spread = F.sum(F.col(f"m2_{c}") + F.col(f"n_{c}") * off * off)
        aggregates += [
            F.max(overall[c]).alias(f"mean_{c}"),
            F.sqrt(F.try_divide(spread, F.nullif(F.sum(f"n_{c}") - 1, F.lit(0)))).alias(f"stddev_{c}"),
        ]
    return parts.agg(*aggregates)


def add_bands(df: DataFrame, bands: Sequence[Band], stats: DataFrame | None = None) -> DataFrame:
    """Label every row against the statistics of the whole frame, or against a row of `stats` kept elsewhere.

    The statistics are one struct-valued scalar subquery: a column-pruned aggregate that runs once,
    is reused by every band, and returns a single row, so nothing is joined and no driver code waits.
    """
    names = list(dict.fromkeys(b.column for b in bands))
    stats = band_stats(df, names) if stats is None else stats
    one_row = stats.select(F.struct(*stats.columns).alias("stats")).scalar()
    return df.withColumns({b.output: _label(b, one_row) for b in bands})


def _label(band: Band, stats: Column) -> Column:
    value = F.col(band.column)
    mean, sd = stats[f"mean_{band.column}"], stats[f"stddev_{band.column}"]
    below = F.when(value < mean - sd, band.low)
    if band.inclusive_top:
        return below.when(value < mean + sd, band.middle).otherwise(band.high)
    return below.when(value > mean + sd, band.high).otherwise(band.middle)
