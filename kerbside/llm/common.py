"""What several corpus operators share: words, written intermediate tables, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Words are runs of anything but the six ASCII white-space characters; other Unicode spaces belong to
# words. `bytes.split()` without arguments splits UTF-8 at exactly these six.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def split_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; a null text has none."""
    return text.encode().split() if text else []


def words(text: Column) -> Column:
    """The words of a text column as an array; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared scratch folder, read back.

    It cuts the lineage with files every executor can read, so a lost executor costs only its own tasks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove written tables whose last reader has itself been written."""
    for table in stored:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose values in a string column take about `limit` bytes; a longer value goes alone."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy()
    ends, at = np.cumsum(sizes.astype(np.int64)), 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of the links (a, b), the smallest node reachable from it.

    Min-label hooking with pointer jumping on tables of one row per node and one row per remaining
    link. Each round a node takes the smallest label next to it, labels are followed one step further,
    and links whose ends agree are dropped; the number of rounds grows with the logarithm of the
    longest shortest path, not with the number of nodes.
    """
    spark = links.sparkSession
    links = links.select("a", "b").where("a <> b")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("component")
        ),
        "labels",
    )
    open_links = both
    while True:
        # The links between the present labels, each once in either direction.
        of = labels.select(F.col("node").alias("a"), F.col("component").alias("x"))
        to = labels.select(F.col("node").alias("b"), F.col("component").alias("y"))
        former = open_links
        open_links = written(
            open_links.join(of, "a").join(to, "b").where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
        if former is not both:
            discard(former)
        if open_links.isEmpty():
            break
        smallest = open_links.groupBy("a").agg(F.min("b").alias("to"))
        hooked = smallest.where("to < a").withColumnRenamed("a", "component")
        moved = labels.join(hooked, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
        former, labels = labels, written(_jumped(moved), "labels")
        discard(former)
    return _settled(labels)


def _jumped(labels: DataFrame) -> DataFrame:
    """Each label replaced by its own label."""
    up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
    return labels.join(up, "component", "left").select(
        "node", F.coalesce("up", "component").alias("component")
    )


def _settled(labels: DataFrame) -> DataFrame:
    """Labels followed until each points at a node that labels itself."""
    while True:
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        if labels.join(up, "component").where("up <> component").isEmpty():
            return labels
        labels = written(_jumped(labels), "labels")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
