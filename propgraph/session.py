"""Session helpers: a tuned SparkSession and the shared checkpoint folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (read from
the session, never overridden). Only a local-mode session without one, as in
tests, gets a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "propgraph",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """A local session tuned for this pipeline (tests, bench, tools)."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    if shuffle_partitions is None:
        shuffle_partitions = 8
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a temporary one only in local mode."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="propgraph-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "propgraph-" + uuid.uuid4().hex[:12], *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table was written at ``path`` (lists it, reads no data)."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder.

    Survives executor loss, and fixes values that a recomputation could
    change (e.g. partition-id tags). Spark's cleaner removes the files once
    the frame is gone (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
