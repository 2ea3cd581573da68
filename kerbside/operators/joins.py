"""Row-level joins that stay balanced when a few keys hold much of the data.

A key is hot when the pairs it makes, its rows on one side times those on the other, are more than one
task should write. Cold keys join as usual; AQE splits a key with many rows on one side only. A hot
key gets a grid of cells, `_rows` by `_columns`, each with at most that many pairs: the left rows are
dealt over the rows of the grid and repeated along its columns, the right rows the other way round,
so every pair meets in exactly one cell. Everything depends on row values and counts alone, never on
row order, so work redone after a lost executor lands where it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that a cell takes from either side, if both have that many: a cell makes at most its square
# of pairs.
HOT_ROWS = 10_000
# Copies of one and the same row are dealt in packs of this many.
PACK = 1_000

ROWS, COLUMNS = "_rows", "_columns"
ROW, COLUMN = "_row", "_column"


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def hot_grid(
    left_counts: DataFrame, right_counts: DataFrame, on: Sequence[str], rows: int = HOT_ROWS
) -> DataFrame:
    """The keys with more than `rows` squared pairs, with the size of their grid.

    One row per hot key. Its size is left to the planner to judge: it broadcasts a small one.
    """
    both = left_counts.join(right_counts.withColumnRenamed("n", "m"), list(on))
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    pairs = n * m / (rows * rows)
    return both.filter(pairs > 1).select(
        *on,
        F.ceil(F.when(m < rows, pairs).when(n < rows, 1.0).otherwise(n / rows)).cast("int").alias(ROWS),
        F.ceil(F.when(n < rows, pairs).when(m < rows, 1.0).otherwise(m / rows)).cast("int").alias(COLUMNS),
    )


def cold(df: DataFrame, grid: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of the other keys."""
    return df.join(grid.select(*on), list(on), "left_anti")


def hot(df: DataFrame, grid: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of the hot keys, with the size of their grid.

    They are picked out as the cold ones are, by a join that keeps or drops rows, so that one shuffle of `df` serves both.
    """
    return df.join(grid.select(*on), list(on), "left_semi").join(grid, list(on))


def _reals(df: DataFrame) -> list[str]:
    """The floating columns; a column that cannot be grouped without changing it is an error.

    Grouping makes 0.0 of -0.0, which `deal` undoes for plain columns only.
    """
    found = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("float", "double"):
            found.append(f.name)
        elif any(part in kind for part in ("map<", "float", "double", "variant")):
            raise ValueError(f"column {f.name} of type {kind} cannot be dealt")
    return found


def deal(df: DataFrame, grid: DataFrame, on: Sequence[str], axis: str, copies: str) -> DataFrame:
    """The hot rows, each in one cell along `axis`; equal rows travel as packs counted in `copies`."""
    reals = _reals(df)
    signs = {f"_minus_{c}": F.coalesce(F.col(c).cast("string") == "-0.0", F.lit(False)) for c in reals}
    packs = (
        hot(df, grid, on)
        .withColumns(signs)
        .groupBy(*df.columns, *signs, ROWS, COLUMNS)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns(
            {c: F.when(F.col(f"_minus_{c}"), F.lit(-0.0).cast(df.schema[c].dataType)).otherwise(F.col(c))
             for c in reals}
        )
        .drop(*signs)
        .withColumn("_pack", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / PACK))))
        .withColumn(copies, F.least(F.lit(PACK), F.col("_n") - F.col("_pack") * PACK))
    )
    cell = F.pmod(F.xxhash64(*df.columns, "_pack"), F.col(axis)).cast("int")
    return packs.withColumn(ROW if axis == ROWS else COLUMN, cell).drop("_n", "_pack")


def repeat(df: DataFrame, axis: str) -> DataFrame:
    """Every row once per cell along `axis`."""
    cells = F.sequence(F.lit(0), F.col(axis) - 1)
    return df.withColumn(ROW if axis == ROWS else COLUMN, F.explode(cells))


def unpack(df: DataFrame, *copies: str) -> DataFrame:
    """One row per combination of the packed copies."""
    total = F.lit(1).cast("bigint")
    for c in copies:
        total = total * F.col(c)
    spare = [*copies, ROWS, COLUMNS, ROW, COLUMN]
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), total))).drop(
        "_copy", *spare
    )


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_counts: DataFrame | None = None,
    right_counts: DataFrame | None = None,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner equi-join, same rows as `left.join(right, on)`.

    The counts (key columns and `n`) may be given where they can be had cheaper than by counting.
    Without hot keys the second branch is empty, which AQE sees before it starts it.
    """
    on = list(on)
    grid = hot_grid(
        key_counts(left, on) if left_counts is None else left_counts,
        key_counts(right, on) if right_counts is None else right_counts,
        on,
        rows,
    )
    usual = cold(left, grid, on).join(cold(right, grid, on), on)
    spread_left = repeat(deal(left, grid, on, ROWS, "_left_copies"), COLUMNS)
    spread_right = repeat(deal(right, grid, on, COLUMNS, "_right_copies"), ROWS).drop(ROWS, COLUMNS)
    spread = spread_left.join(spread_right, [*on, ROW, COLUMN])
    return usual.unionByName(unpack(spread, "_left_copies", "_right_copies"))
