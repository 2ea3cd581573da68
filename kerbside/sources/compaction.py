"""Small files of an append-only table gathered into large ones, without a moment at which rows are missing or double.

A compacted table has a base beside its folder, in numbered versions: the rows, and a manifest of the files
they were read from. The manifest is written last and makes the version valid. Readers take the newest
valid base and those files of the folder that its manifest does not name, so it does not matter whether the
gathered files have been removed yet: a crash before the manifest leaves the old state, one after it the new.
One process compacts a table at a time; others may go on adding to it and reading it. A reader that was planned
before a compaction may find its files gone and is to be planned again, as after any rewrite.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Lake

MANIFEST = "file string"
# A base file takes about this many bytes.
FILE_BYTES = 128 * 1024**2


def _base(lake: Lake, layer: str, name: str, version: int) -> str:
    return f"{lake.path(layer, f'{name}_base')}/v{version}"


def _listed(lake: Lake, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files and folders of a folder; none if there is no such folder."""
    path = lake.spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(lake.spark._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(path)] if fs.exists(path) else []


def _remove(lake: Lake, place: str) -> None:
    path = lake.spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(lake.spark._jsc.hadoopConfiguration()).delete(path, True)


def newest_base(lake: Lake, layer: str, name: str) -> int:
    """The number of the newest valid version; 0 if there is none."""
    versions = [int(v[1:]) for v, _ in _listed(lake, lake.path(layer, f"{name}_base")) if v.startswith("v")]
    valid = [
        v for v in versions
        if any(f == "_SUCCESS" for f, _ in _listed(lake, f"{_base(lake, layer, name, v)}/manifest"))
    ]
    return max(valid, default=0)


def _added(lake: Lake, layer: str, name: str, schema: str) -> DataFrame | None:
    """What the folder itself holds, or None if there is no folder."""
    try:
        return lake.spark.read.schema(schema).parquet(lake.path(layer, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_compacted(lake: Lake, layer: str, name: str, schema: str) -> DataFrame:
    """All rows of a table: the newest base and the files added since. No rows if there is nothing yet."""
    spark, version = lake.spark, newest_base(lake, layer, name)
    added = _added(lake, layer, name, schema)
    if added is None:
        added = spark.createDataFrame([], schema)
    if not version:
        return added
    base = _base(lake, layer, name, version)
    gathered = {r["file"] for r in spark.read.schema(MANIFEST).parquet(f"{base}/manifest").collect()}
    still_there = [f for f, _ in _listed(lake, lake.path(layer, name)) if f in gathered]
    if still_there:
        added = added.where(~F.col("_metadata.file_name").isin(still_there))
    return spark.read.schema(schema).parquet(f"{base}/rows").unionByName(added.select(*added.columns))


def compact(lake: Lake, layer: str, name: str, schema: str, at_least: int = 100) -> int:
    """Gather the files added since the last time, if there are `at_least` so many; returns how many were.

    The names of these files pass through the driver, which has listed them to read them anyway.
    """
    folder = lake.path(layer, name)
    files = [(f, size) for f, size in _listed(lake, folder) if not f.startswith(("_", "."))]
    version = newest_base(lake, layer, name)
    old = _base(lake, layer, name, version)
    if version:
        # A crash may have left files that the base holds already.
        done = {r["file"] for r in lake.spark.read.schema(MANIFEST).parquet(f"{old}/manifest").collect()}
        for f in [f for f, _ in files if f in done]:
            _remove(lake, f"{folder}/{f}")
        files = [x for x in files if x[0] not in done]
    if len(files) < at_least:
        return 0
    new = _base(lake, layer, name, version + 1)
    _remove(lake, new)  # of a compaction that did not get to its manifest
    rows = lake.spark.read.schema(schema).parquet(*[f"{folder}/{f}" for f, _ in files])
    size = sum(size for _, size in files)
    if version:
        rows = lake.spark.read.schema(schema).parquet(f"{old}/rows").unionByName(rows)
        size += sum(size for _, size in _listed(lake, f"{old}/rows"))
    rows.coalesce(1 + size // FILE_BYTES).write.parquet(f"{new}/rows")
    manifest = lake.spark.createDataFrame([(f,) for f, _ in files], MANIFEST)
    manifest.coalesce(1).write.parquet(f"{new}/manifest")
    for f, _ in files:
        _remove(lake, f"{folder}/{f}")
    if version:
        _remove(lake, old)
    return len(files)
