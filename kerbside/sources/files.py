"""The landing files behind paths and globs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def part_of(path: Column) -> Column:
    """The name of the partition that takes a file's rows, from its path alone: a rewritten file keeps it."""
    return F.concat(F.lit("f"), F.substring(F.sha2(path, 256), 1, 24))


def landed_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, size, modified, part) of the files behind paths or globs; no file is opened."""
    listed = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return listed.select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        part_of(F.col("_metadata.file_path")).alias("part"),
    )


def literal_path(path: str) -> str:
    """A path as a glob that matches itself alone."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)
