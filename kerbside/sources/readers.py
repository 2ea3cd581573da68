"""Batch scans of landing files. Types are given, never inferred: inference is a second pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clean import cast_columns

Paths = str | Sequence[str]


def landing_glob(root: str, process: str, prefix: str | None = None, suffix: str = "") -> str:
    """Glob for a process's landing files, one folder per day; no prefix, or "all", means every file."""
    start = "" if prefix in (None, "", "all") else prefix
    return f"{root.rstrip('/')}/data/pre-processed/{process}/*/{start}*{suffix}"


# Holds a record that could not be read as its format; null for all others.
CORRUPT = "_corrupt_record"


def csv_names(reader: DataFrameReader, paths: Paths) -> list[str]:
    """The column names in a file's header, in its order; an unnamed column has an empty name."""
    found = reader.option("header", True).option("inferSchema", False).csv(paths).columns
    return ["" if name == f"_c{i}" else name for i, name in enumerate(found)]


def csv_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in [*names, CORRUPT]])


def read_csv(spark: SparkSession, paths: Paths, names: Sequence[str] | None = None) -> DataFrame:
    """CSV files as text columns named by their header, plus the corrupt record.

    Files of one read must agree on the header: another order or other names raise instead of shifting
    values. A record with fewer or more fields than the header is kept with what was read and shows
    up in the corrupt record. `names` is for files without a header, which go by position.
    """
    given = list(names) if names is not None else csv_names(spark.read, paths)
    reader = (
        spark.read.schema(csv_schema(given))
        .option("header", names is None)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    df = reader.csv(paths)
    named = [f"`{n}`" for n in given if n]
    return df.select(*named, CORRUPT)


def read_json(
    spark: SparkSession, paths: Paths, schema: str, multiline: bool = False
) -> DataFrame:
    """JSON lines, or with `multiline` whole-file documents; an array of objects gives a row each.

    A record that is no JSON object has nulls and shows up in the corrupt record. Lines split across
    tasks; a multi-line document is parsed by one task, so keep those files small.
    """
    reader = spark.read.schema(f"{schema}, `{CORRUPT}` string")
    return (
        reader.option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    )


def read_parquet(spark: SparkSession, paths: Paths, casts: dict[str, str] | None = None) -> DataFrame:
    """Parquet files, then the lenient casts; columns the files lack are left out."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return cast_columns(df, casts)[0] if casts else df


def corrupt_count(df: DataFrame) -> list[Column]:
    """The number of records that could not be read, where the format can have such."""
    return [F.count(CORRUPT).alias("corrupt")] if CORRUPT in df.columns else []
