"""The ledger of loaded files: which state of which landing file is in a raw table.

A file is known by its path, its size and its modification time. Each load adds a row for every file it took,
under the name of the partition that holds the file's rows; the newest row of a path counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .compaction import compact, read_compacted
from .files import landed_files
from .tables import Lake

LEDGER_TABLE = "load_ledger"
LEDGER = "dataset string, path string, size bigint, modified timestamp, part string, loaded_ts timestamp"


def read_ledger(lake: Lake) -> DataFrame:
    """All entries; none before the first load."""
    return read_compacted(lake, "catalog", LEDGER_TABLE, LEDGER)


def compact_ledger(lake: Lake, at_least: int = 100) -> int:
    """Gather the ledger's files, one a load, once there are so many."""
    return compact(lake, "catalog", LEDGER_TABLE, LEDGER, at_least)


def latest(ledger: DataFrame, dataset: str) -> DataFrame:
    """The newest entry of every path of a dataset."""
    newest = Window.partitionBy("path").orderBy(F.desc("loaded_ts"))
    return (
        ledger.where(F.col("dataset") == dataset)
        .withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
    )


def pending(lake: Lake, dataset: str, paths: str | Sequence[str]) -> DataFrame:
    """(path, size, modified, part) of the landed files whose present state is not in the raw table."""
    known = latest(read_ledger(lake), dataset).select("path", "size", "modified")
    return landed_files(lake.spark, paths).join(known, ["path", "size", "modified"], "left_anti")


def enter(lake: Lake, dataset: str, files: DataFrame) -> None:
    """Record files as loaded. Written after their rows: a load cut off in between is simply repeated."""
    rows = files.select(
        F.lit(dataset).alias("dataset"), "path", "size", "modified", "part", F.current_timestamp().alias("loaded_ts")
    )
    rows.coalesce(1).write.mode("append").parquet(lake.path("catalog", LEDGER_TABLE))
