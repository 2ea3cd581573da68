"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job benefits from. Cluster size, memory and the shuffle partition ceiling belong to
# spark-submit; AQE coalesces from that ceiling down to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_scratch(spark: SparkSession) -> None:
    """Give a local-mode session without a scratch folder one that goes when the process ends.

    For tests, benches and trial runs on one machine. A session whose `spark.checkpoint.dir` is set, or
    that runs on a cluster, is left as it is.
    """
    master = spark.sparkContext.master
    if scratch_root(spark) is None and (master == "local" or master.startswith("local[")):
        folder = tempfile.mkdtemp(prefix="kerbside-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)


def scratch_root(spark: SparkSession) -> str | None:
    """The shared folder of this session: `spark.checkpoint.dir`, else what setCheckpointDir was given."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder that all executors and a restarted driver can see."""
    root = scratch_root(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/kerbside/{label}-{uuid.uuid4().hex}"
