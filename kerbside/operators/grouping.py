"""Period rollups, shares of a total and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import period


def by_period(
    df: DataFrame, ts: str, unit: str, keys: Sequence[str], aggs: Sequence[Column], output: str
) -> DataFrame:
    """Group by the start of the period, under a new name.

    The period column never shares its source's name: SQL engines disagree on which of the two a
    GROUP BY means, and the raw one would give a row per date.
    """
    if output == ts:
        raise ValueError("name the period column differently from its source")
    return df.groupBy(period(F.col(ts), unit).alias(output), *keys).agg(*aggs)


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The k first rows of each group with their row number.

    The rank filter sits right on the window, so Spark keeps k rows per group and task before the
    shuffle; a hot group never lands whole in one task. Give `order` a tie-break for stable results.
    """
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)


def share_of(
    df: DataFrame, measure: str, by: Sequence[str], output: str = "share", of: DataFrame | None = None
) -> DataFrame:
    """Fraction each row's measure has of its group's total in `of` (default: of `df` itself).

    Totals come from a two-step aggregate joined back on the group, not from a whole-partition
    window: the window would send each group to a single task. Null groups form a group as usual.
    """
    totals = (df if of is None else of).groupBy(
        *[F.col(c).alias(f"_total_{c}") for c in by]
    ).agg(F.sum(measure).alias("_total"))
    same_group = [F.col(c).eqNullSafe(F.col(f"_total_{c}")) for c in by]
    joined = df.join(totals, same_group)
    share = F.col(measure) * F.lit(1.0) / F.col("_total")
    return joined.withColumn(output, share).select(*df.columns, output)


def latest(df: DataFrame, ts: str, *tie_break: str) -> DataFrame:
    """The newest row; a one-row top-k, not a full sort."""
    return df.orderBy(F.desc(ts), *[F.desc(c) for c in tie_break]).limit(1)
