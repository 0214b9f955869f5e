"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # Wall times are UTC; date parts must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    # AQE sizes shuffle partitions, splits skewed joins and rebalances the partitioned writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A re-run replaces the years it computed and nothing else.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Station files are about a megabyte: with the 4 MB default a task would get some thirty of them.
    "spark.sql.files.openCostInBytes": str(1 << 20),
    "spark.ui.enabled": "false",
}

# On a cluster only; a local session keeps Spark's small-data defaults.
CLUSTER_DEFAULTS = {
    # AQE merges partitions but cannot split the one a window or aggregate needs, so start with many
    # (a 4 TB year then gives 500 MB each) ...
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    # ... and merge up to this size, not merely until every core has work: it sets the size of files.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
}


def build_session(app: str = "pluvia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots and win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        for key, value in CLUSTER_DEFAULTS.items():
            if key not in settings:
                spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without that setting; it then gets a temporary folder.  What is written there
    is removed when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pluvia-")
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if jvm := getattr(spark, "_jvm", None):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        filesystem = path.getFileSystem(spark._jsc.hadoopConfiguration())
        filesystem.mkdirs(path)
        filesystem.deleteOnExit(path)
    return f"{folder}/data"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: without one it means Spark's default filesystem, on every machine."""
    parsed = spark._jvm.org.apache.hadoop.fs.Path(path)
    return parsed.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(parsed).toString()
