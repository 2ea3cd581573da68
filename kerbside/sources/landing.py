"""Landing files of any format as one scan, before casting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import text_schema
from .headers import header_groups, read_groups
from .json_arrays import read_json_array
from .readers import Paths, read_csv, read_json, read_parquet


def read_landing(
    spark: SparkSession,
    dataset: str,
    fmt: str,
    paths: Paths,
    multiline: bool = False,
    arrays: bool = False,
    drift: bool = False,
) -> DataFrame:
    """A dataset's landing files in any of the three formats, before casting.

    CSV files bring the columns their header names, in any order, with whatever more they hold; with `drift`
    their headers may differ from file to file. `arrays` reads files that are one JSON array each by many tasks.
    """
    if fmt == "csv":
        return read_groups(spark, header_groups(spark, paths)) if drift else read_csv(spark, paths)
    if fmt == "json":
        if arrays:
            return read_json_array(spark, paths, text_schema(dataset))
        return read_json(spark, paths, text_schema(dataset), multiline)
    if fmt == "parquet":
        return read_parquet(spark, paths)
    raise ValueError(f"unknown landing format {fmt!r}")


def file_path(landed: DataFrame) -> Column:
    """The path of the file that a row of `read_landing` comes from."""
    return F.col("_path") if "_path" in landed.columns else F.col("_metadata.file_path")
