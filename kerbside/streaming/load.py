"""Incremental file loads: a file-source stream drained in byte-bounded batches."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import bad_value_counts, conform
from ..schemas import CASTS, text_schema, typed_schema
from ..sources.readers import CORRUPT, corrupt_count, csv_names, csv_schema
from ..sources.runlog import logged_run
from ..sources.tables import Lake

# Bytes of landing files that one core reads in one batch, by default; a batch holds that for every
# core there is, so that large clusters drain large backlogs in few batches.
BYTES_PER_CORE = 16 * 128 * 1024**2

CHECKS = "checks"
# Readers of a streamed table see only the files its stream logged, so it is kept apart from the
# tables that batch loads write.
LAYER = "raw_stream"


@dataclass(frozen=True)
class Loaded:
    rows: int
    batches: int
    bad_values: dict[str, int]


def read_landing_stream(
    spark: SparkSession,
    dataset: str,
    fmt: str,
    folder: str,
    max_bytes: int | None = None,
    pattern: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """A dataset's landing folder as a stream. `pattern` selects file names, as a glob.

    The columns of CSV files are those of the header found now; a file with another header fails the
    load rather than shift values. `max_bytes` bounds a batch; a larger file is a batch of its own.
    """
    if max_bytes is None:
        max_bytes = BYTES_PER_CORE * spark.sparkContext.defaultParallelism
    if fmt == "csv":
        files = spark.read.option("recursiveFileLookup", True)
        schema = csv_schema(csv_names(files.option("pathGlobFilter", pattern) if pattern else files, folder))
    elif fmt == "json":
        schema = f"{text_schema(dataset)}, `{CORRUPT}` string"
    else:
        schema = typed_schema(dataset)
    reader = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxBytesPerTrigger", max_bytes)
        .option("recursiveFileLookup", True)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if fmt != "parquet":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("columnPruning", False)
    if fmt == "json":
        reader = reader.option("multiLine", multiline)
    return reader.load(folder)


def load_stream(
    lake: Lake,
    dataset: str,
    fmt: str,
    folder: str,
    checkpoint: str,
    max_bytes: int | None = None,
    pattern: str | None = None,
    multiline: bool = False,
) -> Loaded:
    """Append every landing file not loaded before to the streamed raw table, once each, then stop.

    The checkpoint remembers the files, so they are neither moved nor deleted, and a run that dies
    half-way is picked up by the next one. Keep one checkpoint per raw table, on shared storage.
    """
    types = CASTS[dataset]
    landed = read_landing_stream(lake.spark, dataset, fmt, folder, max_bytes, pattern, multiline)
    checks = [F.count(F.lit(1)).alias("rows")]
    if fmt != "parquet":
        checks += [*corrupt_count(landed), *bad_value_counts(landed, types)]
    typed, _ = conform(landed.observe(CHECKS, *checks), types)
    with logged_run(lake, f"load-{dataset}") as run:
        query = (
            typed.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .option("path", lake.path(LAYER, dataset))
            .trigger(availableNow=True)
            .start()
        )
        loaded = _follow(query)
        run.rows = loaded.rows
    return loaded


def _follow(query) -> Loaded:
    """Wait for the drain, adding up each batch's metrics.

    Spark keeps only the most recent progress reports, hence the polling.
    """
    seen: dict[int, dict] = {}
    done = False
    while not done:
        done = query.awaitTermination(1)
        for progress in query.recentProgress:
            report = json.loads(progress.json)
            checks = report.get("observedMetrics", {}).get(CHECKS)
            if checks:
                seen[report["batchId"]] = checks
    totals: dict[str, int] = {}
    for checks in seen.values():
        for name, value in checks.items():
            totals[name] = totals.get(name, 0) + value
    rows = totals.pop("rows", 0)
    return Loaded(rows, len(seen), {k: v for k, v in totals.items() if v})
