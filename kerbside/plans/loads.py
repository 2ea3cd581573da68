"""Landing to raw, in batches or in time windows, and raw to prod."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from ..functions.clean import bad_value_counts, conform
from ..operators.bands import merged_stats, moments
from ..operators.slices import month_bounds, month_slice, slice_end, time_slice, time_slices
from ..schemas import CASTS
from ..sources.files import literal_path, part_of
from ..sources.landing import file_path, read_landing
from ..sources.ledger import enter, pending
from ..sources.readers import Paths, corrupt_count
from ..sources.runlog import SUCCESS, Run, log_runs, logged_run, now, resume_from
from ..sources.tables import Lake

# The window, in days, that one run of each process asks for.
WINDOW_DAYS = {"crashes": 60, "vehicles": 60, "persons": 60, "weather": 60, "traffic": 15}


def load_batch(
    lake: Lake,
    dataset: str,
    fmt: str,
    paths: Paths,
    day: str | None = None,
    batch: str | None = None,
    **options: bool,
) -> dict:
    """Landing files to the raw table, with a typed parquet archive of the batch.

    Only files that the ledger does not know in their present state are taken, so a folder that keeps
    filling can be loaded by the same glob again and again. Every file has a partition of its own in the raw
    table, named after its path: a file that was rewritten replaces its former rows, and a load that was cut
    off and is repeated replaces its own. Rows of a file that has left the folder stay. Without new files
    nothing is written but the log.

    With `batch` the files are taken as they are, ledger or not, as the one partition of that name, which a
    repeated load replaces; don't name batches of files that are also loaded by the ledger. `options` are those
    of `read_landing`: headers that differ from file to file, JSON arrays read by many tasks.

    The text is parsed once, into the archive; the raw table takes that columnar copy. Returns the row
    count, the number of files taken, the unreadable records, the unreadable values per column and the
    missing columns. The names of the files taken pass through the driver, as in any Spark read.
    """
    types = CASTS[dataset]
    with logged_run(lake, f"load-{dataset}") as run:
        if batch is None:
            new = pending(lake, dataset, paths)
            taken = new.collect()
            if not taken:
                run.rows = 0
                return {"rows": 0, "files": 0, "landed": 0, "missing": []}
            paths = [literal_path(r["path"]) for r in taken]
        landed = read_landing(lake.spark, dataset, fmt, paths, **options)
        part = F.lit(batch) if batch else part_of(file_path(landed))
        quality = Observation()
        checked = landed.withColumn("load_batch", part).observe(
            quality,
            F.count(F.lit(1)).alias("landed"),
            *corrupt_count(landed),
            *bad_value_counts(landed, types),
        )
        typed, missing = conform(checked, types, keep=["load_batch"])
        name = batch or _named_after(taken)
        copy, _ = lake.archive(typed, dataset, day or now().date().isoformat(), name)
        run.rows = lake.overwrite(
            copy, "raw", dataset, ["load_batch"], partitions_only=True, rebalance=False
        )["rows"]
        found = {"rows": run.rows, "missing": missing, **quality.get}
        if not batch:
            # The files as they were listed: read now, one may have changed since.
            files = lake.spark.createDataFrame(taken, new.schema)
            # A file rewritten without rows leaves none behind to replace its former ones.
            filled = copy.select(F.col("load_batch").alias("part")).distinct()
            for r in files.join(filled, "part", "left_anti").collect():
                lake.drop_partition("raw", dataset, "load_batch", r["part"])
            enter(lake, dataset, files)
            found["files"] = len(taken)
    return found


def _named_after(files: Sequence[Row]) -> str:
    """One name for the same files in the same state, whatever their order."""
    states = sorted(f"{r['path']} {r['size']} {r['modified']}" for r in files)
    return "b" + hashlib.sha256("\n".join(states).encode()).hexdigest()[:24]


def high_water(source: DataFrame, ts: str) -> dt.datetime | None:
    """The newest time a source has delivered: one value, null for an empty source."""
    return source.agg(F.max(ts).alias("newest")).first()["newest"]


def load_increment(
    lake: Lake,
    source: DataFrame,
    name: str,
    ts: str,
    default_start: dt.datetime,
    days: int | None = None,
    closed: str = "left",
    delivered: dt.datetime | None = None,
) -> Run:
    """Load the next window of a source, from where the last successful run stopped.

    `delivered` is the time up to which the source is known to be complete; by default that is the
    newest time it holds. A window that ends by then is closed and the process moves on, empty or not.
    A window that reaches beyond stays open: its rows so far are loaded, the process stays at its start,
    and the next run replaces them together with whatever came late.
    """
    with logged_run(lake, f"ingest-{name}") as run:
        length = days or WINDOW_DAYS[name]
        start = resume_from(lake, run.process, default_start)
        window = time_slice(source, ts, start, length, closed)
        run.rows = _replace(lake, window, name, "window_start", F.lit(start.date()))
        run.last_timestamp = _next_start(
            start, slice_end(start, length), delivered or high_water(source, ts)
        )
    return run


def load_month(
    lake: Lake,
    source: DataFrame,
    name: str,
    ts: str,
    default_start: dt.datetime,
    delivered: dt.datetime | None = None,
) -> Run:
    """As `load_increment`, for a source delivered in calendar months."""
    with logged_run(lake, f"ingest-{name}") as run:
        start, after = month_bounds(resume_from(lake, run.process, default_start))
        month = month_slice(source, ts, start)
        run.rows = _replace(lake, month, name, "window_start", F.lit(start.date()))
        run.last_timestamp = _next_start(start, after, delivered or high_water(source, ts))
    return run


def _next_start(start: dt.datetime, end: dt.datetime, delivered: dt.datetime | None) -> dt.datetime:
    return end if delivered is not None and end <= delivered else start


def catch_up(
    lake: Lake,
    source: DataFrame,
    name: str,
    ts: str,
    default_start: dt.datetime,
    days: int | None = None,
    delivered: dt.datetime | None = None,
) -> list[Run]:
    """All windows from the resume point to the newest row, written in one job.

    The same table as repeated `load_increment`s, and one logged run per window; the resume point stops at
    the first window that the source is not complete for.
    """
    process, length = f"ingest-{name}", days or WINDOW_DAYS[name]
    first = Run(process, now())
    try:
        start = resume_from(lake, process, default_start)
        newest = high_water(source, ts)
        complete = delivered or newest
        runs, at, point = [], start, start
        while newest is not None and at <= max(newest, complete):
            end = slice_end(at, length)
            if point == at:  # only up to the first open window
                point = _next_start(at, end, complete)
            runs.append(Run(process, first.start, 0, point))
            at = end
        tagged = time_slices(source, ts, start, length, "_window", "left")
        day = F.date_add(F.lit(start.date()), F.col("_window") * length)
        rows = tagged.withColumn("window_start", day).drop("_window")
        lake.overwrite(rows, "raw", name, ["window_start"], partitions_only=True)
        counts = lake.read_table("raw", name).where(F.col("window_start") >= F.lit(start.date()))
        for r in counts.groupBy("window_start").count().collect():
            runs[(r["window_start"] - start.date()).days // length].rows = r["count"]
    except Exception:
        log_runs(lake, [first])
        raise
    for run in runs:
        run.status = SUCCESS
    log_runs(lake, runs)
    return runs


def merge_late(
    lake: Lake,
    late: DataFrame,
    name: str,
    ts: str,
    default_start: dt.datetime,
    keys: Sequence[str],
    version: str,
    days: int | None = None,
) -> dict:
    """Bring rows that came after their window was closed into the raw table.

    Of rows with the same keys in a window the one with the greatest version stays, of equal versions the one
    that is greatest column by column, so a row may come twice and in any order, and a rerun changes nothing.
    Only the windows that `late` has rows of are rewritten. Rows of windows that are still open are left to
    the next load, which takes these windows anew. Returns the windows rewritten, their rows, and the rows left.
    """
    with logged_run(lake, f"late-{name}") as run:
        length = days or WINDOW_DAYS[name]
        point = run.last_timestamp = resume_from(lake, f"ingest-{name}", default_start)
        tagged = time_slices(late, ts, default_start, length, "_window", "left")
        day = F.date_add(F.lit(default_start.date()), F.col("_window") * length)
        placed = tagged.withColumn("window_start", day).drop("_window")
        closed = placed.where(F.col("window_start") < F.lit(point.date()))
        counts = {r["window_start"]: r["count"] for r in placed.groupBy("window_start").count().collect()}
        windows = sorted(w for w in counts if w < point.date())
        run.rows = 0
        if windows:
            kept = lake.read_table("raw", name)
            both = kept.where(F.col("window_start").isin(windows)).unionByName(closed.select(*kept.columns))
            value = F.struct(version, *[c for c in kept.columns if c not in (*keys, "window_start", version)])
            best = both.groupBy("window_start", *keys).agg(F.max(value).alias("_best"))
            merged = best.select("window_start", *keys, "_best.*").select(*kept.columns)
            run.rows = lake.overwrite(merged, "raw", name, ["window_start"], partitions_only=True)["rows"]
    return {"windows": windows, "rows": run.rows, "open": sum(n for w, n in counts.items() if w not in windows)}


def update_moments(
    lake: Lake, name: str, columns: Sequence[str], windows: Sequence[dt.date]
) -> None:
    """Keep the moments of a raw table's windows: those given are scanned, all others stay as they are.

    Call it with the windows that a load or a late merge wrote; a window without rows loses its moments.
    """
    windows = sorted(set(windows))
    rows = lake.read_table("raw", name).where(F.col("window_start").isin(windows))
    found = moments(rows, columns, ["window_start"])
    lake.overwrite(found, "moments", name, ["window_start"], partitions_only=True)
    present = {r["window_start"] for r in lake.read_table("moments", name).select("window_start").distinct().collect()}
    filled = {r["window_start"] for r in rows.select("window_start").distinct().collect()}
    for window in present & set(windows) - filled:
        lake.drop_partition("moments", name, "window_start", window.isoformat())


def kept_stats(lake: Lake, name: str, columns: Sequence[str]) -> DataFrame:
    """`band_stats` of a whole raw table, from its kept moments: one small row a window is read."""
    return merged_stats(lake.read_table("moments", name), columns)


def run_transform(
    lake: Lake,
    dataset: str,
    transform: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    layer: str = "raw",
) -> dict:
    """Raw table (or another layer's) to prod table in one write, counted by it and logged."""
    with logged_run(lake, f"transform-{dataset}") as run:
        prod = transform(lake.read_table(layer, dataset))
        metrics = lake.overwrite(prod, "prod", dataset, partition_by)
        run.rows = metrics["rows"]
    return metrics


def _replace(lake: Lake, rows: DataFrame, name: str, column: str, value: Column) -> int:
    """Add rows to a raw table as the partition of their load; a repeated load replaces it."""
    tagged = rows.withColumn(column, value)
    return lake.overwrite(tagged, "raw", name, [column], partitions_only=True, rebalance=False)[
        "rows"
    ]
