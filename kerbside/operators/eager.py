"""Aggregation before the join: what a many-to-many join would count, without building its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, keys: Sequence[str], output: str) -> DataFrame:
    """Distinct key combinations with the number of rows behind each."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))


def measured(df: DataFrame, keys: Sequence[str], measures: Sequence[str], rows: str) -> DataFrame:
    """Per key: row count, and per measure its sum and its non-null count."""
    aggregates = [F.count(F.lit(1)).alias(rows)]
    for m in measures:
        aggregates += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"count_{m}")]
    return df.groupBy(*keys).agg(*aggregates)


def pair_average(weight: Column, measure: str) -> Column:
    """Average of a measure over joined pairs, from `measured` rows and the other side's weight.

    Null when no pair has a value. Weights enter as doubles: products of counts can pass 64 bits.
    """
    w = weight.cast("double")
    return F.try_divide(F.sum(w * F.col(f"sum_{measure}")), F.sum(w * F.col(f"count_{measure}")))


def weighted_average(weight: Column, value: Column) -> Column:
    """AVG(value) as if each row stood for `weight` rows; null values do not count."""
    w = weight.cast("double")
    return F.try_divide(F.sum(w * value), F.sum(F.when(value.isNotNull(), w)))
