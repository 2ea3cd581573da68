"""Time slices, resume points and series expansion."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import ntz


def slice_end(start: dt.datetime, days: int) -> dt.datetime:
    return start + dt.timedelta(days=days)


def month_bounds(start: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """First instant of the month holding `start` and of the one after."""
    first = dt.datetime(start.year, start.month, 1)
    return first, dt.datetime(first.year + first.month // 12, first.month % 12 + 1, 1)


def time_slice(
    df: DataFrame,
    ts: str,
    start: dt.datetime,
    days: int,
    closed: str = "both",
) -> DataFrame:
    """Rows of the window of `days` from `start`.

    closed="both" keeps rows at either bound, so back-to-back windows repeat the boundary rows;
    closed="left" tiles.
    """
    end = slice_end(start, days)
    col = F.col(ts)
    if closed == "both":
        return df.filter((col >= ntz(start)) & (col <= ntz(end)))
    if closed == "left":
        return df.filter((col >= ntz(start)) & (col < ntz(end)))
    raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")


def time_slices(
    df: DataFrame, ts: str, start: dt.datetime, days: int, output: str, closed: str = "both"
) -> DataFrame:
    """Rows from `start` on, tagged with the number of their window of `days`, in one pass.

    closed="both": a row exactly on a later bound belongs to the two windows that meet there.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    micros = F.timestamp_diff("MICROSECOND", ntz(start), F.col(ts))
    length = F.lit(days * 24 * 3600 * 1_000_000)
    number = F.floor(micros / length).cast("int")
    windows = F.array(number)
    if closed == "both":
        on_bound = (micros % length == 0) & (number > 0)
        windows = F.when(on_bound, F.array(number - 1, number)).otherwise(windows)
    return df.filter(F.col(ts) >= ntz(start)).select(F.explode(windows).alias(output), "*")


def month_slice(df: DataFrame, ts: str, start: dt.datetime) -> DataFrame:
    """Rows of the calendar month holding `start`, tagged with that month's year and number."""
    first, after = month_bounds(start)
    col = F.col(ts)
    rows = df.filter((col >= ntz(first)) & (col < ntz(after)))
    return rows.withColumns(
        {"data_file_year": F.lit(first.year), "data_file_month": F.lit(first.month)}
    )


def month_key(col: Column) -> Column:
    """yyyy-MM text of a timestamp, as used in monthly file names."""
    return F.substring(F.trunc(col, "month").cast("string"), 1, 7)


def resume_point(log: DataFrame, process: str, default: dt.datetime) -> DataFrame:
    """One row: where the process continues.

    The newest successful run decides; when it carries no timestamp, or there is none, the default
    does. max_by keeps one candidate per task, and the global aggregate yields a row for an empty log.
    """
    success = (F.col("process_name") == process) & (F.col("process_status") == "Success")
    newest = F.max_by(F.struct("last_timestamp_loaded"), F.struct("insert_ts", "last_timestamp_loaded"))
    return log.filter(success).agg(
        F.coalesce(newest["last_timestamp_loaded"], ntz(default)).alias(
            "resume_from"
        )
    )


def resume_points(log: DataFrame, default: dt.datetime) -> DataFrame:
    """`resume_point` of every process in the log, in one grouped pass."""
    order = F.when(
        F.col("process_status") == "Success", F.struct("insert_ts", "last_timestamp_loaded")
    )
    newest = F.max_by(F.struct("last_timestamp_loaded"), order)
    return log.groupBy("process_name").agg(
        F.coalesce(newest["last_timestamp_loaded"], ntz(default)).alias("resume_from")
    )


def expand_series(
    df: DataFrame, start: str, end: str, step_seconds: str, arrays: Sequence[str], output: str
) -> DataFrame:
    """One row per step of [start, end), taking element i of every array for step i.

    Other columns repeat. The explode is row-local: no shuffle. An array that has not exactly one value
    per step is an error, as neither the missing nor the spare values have a time; a null array counts
    as all nulls. An empty span gives no row and needs empty arrays.
    """
    step = F.make_dt_interval(secs=F.col(step_seconds))
    last_instant = F.col(end) - F.expr("interval 1 microsecond")
    steps = F.when(
        F.col(start) < F.col(end), F.sequence(F.col(start), last_instant, step)
    )
    keep = [c for c in df.columns if c not in {start, end, step_seconds, *arrays}]
    wanted = F.coalesce(F.size(steps), F.lit(0))
    wrong = F.lit(False)
    for a in arrays:
        wrong = wrong | (F.col(a).isNotNull() & (F.size(a) != wanted))
    message = F.concat(F.lit("series with other than "), wanted.cast("string"), F.lit(" values"))
    checked = F.when(wrong, F.raise_error(message).cast("array<timestamp_ntz>")).otherwise(steps)
    zipped = F.inline(F.arrays_zip(checked, *[F.coalesce(F.col(a), _nulls(df, a, steps)) for a in arrays]))
    return df.select(*keep, zipped.alias(output, *arrays)).filter(F.col(output).isNotNull())


def _nulls(df: DataFrame, array: str, steps: Column) -> Column:
    """As many nulls as there are steps, in the array's type."""
    element = df.schema[array].dataType.elementType
    return F.transform(steps, lambda _: F.lit(None).cast(element))


def window_per_location(dim: DataFrame, start: dt.datetime, days: int) -> DataFrame:
    """The same [start, end) window for every location of the dimension."""
    return dim.withColumns({"start": ntz(start), "end": ntz(slice_end(start, days))})


def with_location(df: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Tag rows with the dimension's attributes, replacing any the rows brought along.

    No broadcast hint: the planner broadcasts a small dimension by its measured size and shuffles a
    large one.
    """
    own = [c for c in df.columns if c not in attributes]
    return df.select(*own).join(dim.select(key, *attributes), key)
