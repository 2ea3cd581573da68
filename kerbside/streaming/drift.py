"""Incremental loads of CSV folders whose files differ in their headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.clean import bad_value_counts, conform
from ..schemas import CASTS
from ..sources.files import literal_path
from ..sources.headers import header_groups, read_groups
from ..sources.readers import corrupt_count
from ..sources.runlog import logged_run
from ..sources.tables import Lake
from .load import LAYER, Loaded

LISTED = "path string, modificationTime timestamp, length bigint, content binary"
BATCH = "load_batch"


def load_stream_drift(
    lake: Lake,
    dataset: str,
    folder: str,
    checkpoint: str,
    files: int = 1000,
    pattern: str | None = None,
) -> Loaded:
    """Add every landing file not loaded before to the streamed raw table, each by its own header, then stop.

    The stream carries the names of files, not their rows; a batch of at most `files` is grouped by header, read
    and written as the partition of its number. A batch that is repeated after a failure replaces its partition,
    so each file's rows are there once. Keep to one way of streaming a table: readers of a table that
    `load_stream` wrote see only what its own log lists.
    """
    types, totals = CASTS[dataset], {}
    batches = 0

    def write(listed: DataFrame, number: int) -> None:
        nonlocal batches
        paths = [literal_path(r["path"]) for r in listed.select("path").collect()]
        groups = header_groups(lake.spark, paths) if paths else {}
        batches += 1
        if not groups:
            return
        landed, quality = read_groups(lake.spark, groups), Observation()
        checks = [*corrupt_count(landed), *bad_value_counts(landed, types)]
        checked = landed.withColumn(BATCH, F.lit(number)).observe(quality, F.count(F.lit(1)).alias("rows"), *checks)
        typed, _ = conform(checked, types, keep=[BATCH])
        lake.overwrite(typed, LAYER, dataset, [BATCH], partitions_only=True, rebalance=False)
        for name, value in quality.get.items():
            totals[name] = totals.get(name, 0) + value

    reader = (
        lake.spark.readStream.format("binaryFile").schema(LISTED)
        .option("maxFilesPerTrigger", files).option("recursiveFileLookup", True)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    with logged_run(lake, f"load-{dataset}") as run:
        query = (
            reader.load(folder).select("path").writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        run.rows = totals.pop("rows", 0)
    return Loaded(run.rows, batches, {k: v for k, v in totals.items() if v})
