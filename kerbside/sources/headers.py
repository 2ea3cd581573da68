"""CSV files whose header changed over time: grouped by header, read group by group, united by name."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import landed_files, literal_path
from .readers import CORRUPT, csv_names, read_csv

# Headers that are looked up at a time.
AT_ONCE = 16

Groups = Mapping[tuple[str, ...], Sequence[str]]


def header_groups(spark: SparkSession, paths: str | Sequence[str]) -> Groups:
    """The files behind paths or globs by their header; files without any content are left out.

    Of each file only the first line is fetched, some at a time; names of files and headers pass through the
    driver. Meant for the new files of a load, not for a whole archive of small ones.
    """
    found = [literal_path(r["path"]) for r in landed_files(spark, paths).where("size > 0").select("path").collect()]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        headers = list(pool.map(lambda path: tuple(csv_names(spark.read, path)), found))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(zip(found, headers)):
        if header:
            groups.setdefault(header, []).append(path)
    return groups


def read_groups(spark: SparkSession, groups: Groups) -> DataFrame:
    """Every group read by its own header, united by name, with the path of each row's file as `_path`.

    A column that a file lacks is null there. Names differ by more than case. Columns stand in the order of the
    headers that have most files, later ones follow.
    """
    if not groups:
        raise ValueError("none of the files has a header")
    ordered = sorted(groups.items(), key=lambda g: (-len(g[1]), g[0]))
    parts = []
    for _, files in ordered:
        rows = read_csv(spark, list(files)).withColumn("_path", F.col("_metadata.file_path"))
        parts.append(rows)
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.select(*[c for c in united.columns if c not in (CORRUPT, "_path")], CORRUPT, "_path")


def drift_report(spark: SparkSession, groups: Groups) -> DataFrame:
    """(column, files, missing_files, headers, positions): how far the files agree on each column.

    `headers` is the number of different headers that hold the column, `positions` of places it stands at.
    A column in all files at one place has not drifted.
    """
    total = sum(len(files) for files in groups.values())
    files, headers, places = Counter(), Counter(), {}
    for header, members in groups.items():
        for at, name in enumerate(header):
            if name:
                files[name] += len(members)
                headers[name] += 1
                places.setdefault(name, set()).add(at)
    return spark.createDataFrame(
        [(n, files[n], total - files[n], headers[n], len(places[n])) for n in sorted(files)],
        "column string, files bigint, missing_files bigint, headers bigint, positions bigint",
    )
