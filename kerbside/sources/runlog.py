"""The run log: one typed row per run, and where a process resumes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame

from ..operators.slices import resume_point
from ..schemas import RUN_LOG
from .compaction import compact, read_compacted
from .tables import Lake

SUCCESS = "Success"
FAILURE = "Failure"
LOG_TABLE = "process_catalog"


@dataclass
class Run:
    """What a job reports about itself while it runs."""

    process: str
    start: dt.datetime
    rows: int | None = None
    last_timestamp: dt.datetime | None = None
    status: str = field(default=FAILURE)


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def read_log(lake: Lake) -> DataFrame:
    """All logged runs; none before the first one has been logged."""
    return read_compacted(lake, "catalog", LOG_TABLE, RUN_LOG)


def compact_log(lake: Lake, at_least: int = 100) -> int:
    """Gather the log's files, one a run, once there are so many; returns how many were gathered."""
    return compact(lake, "catalog", LOG_TABLE, RUN_LOG, at_least)


def log_runs(lake: Lake, runs: Sequence[Run]) -> None:
    """Add runs to the log, in order: the last one counts as the newest."""
    end = now()
    rows = [
        (
            run.process, run.status, run.start, end,
            Decimal(str(round((end - run.start).total_seconds(), 3))), None, run.last_timestamp,
            run.rows, now() + dt.timedelta(microseconds=i),
        )
        for i, run in enumerate(runs)
    ]
    # A few rows, one task: the session's default parallelism would write a folder of empty files.
    lake.spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(
        lake.path("catalog", LOG_TABLE)
    )


@contextmanager
def logged_run(lake: Lake, process: str) -> Iterator[Run]:
    """Log the run when the block ends: Success with its figures, or Failure, and the error goes on."""
    run = Run(process, now())
    try:
        yield run
        run.status = SUCCESS
    finally:
        log_runs(lake, [run])


def resume_from(lake: Lake, process: str, default: dt.datetime) -> dt.datetime:
    """The resume point as a value: one row by construction."""
    return resume_point(read_log(lake), process, default).first()["resume_from"]
