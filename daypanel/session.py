"""Session construction and the shared folder used to cut lineage.

On a cluster, ``spark.checkpoint.dir`` names a folder every executor can reach
(HDFS / object store).  Jobs read that setting from the session; only when it is
unset (local tests) do we create a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "daypanel") -> SparkSession:
    """Session tuned for panel jobs: AQE on, UTC, no UI, Arrow for pandas hand-offs."""
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or max(8, cpus * 2)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DAYPANEL_DRIVER_MEMORY", "16g"))
        # 32 MB: dimension tables and fold/weight tables fall under it, fact tables never do.
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    Uses ``spark.checkpoint.dir`` when the session names one; otherwise, in local
    mode only (tests), sets it to a new private folder first.  On a cluster a folder
    of one machine would lose what the executors write, so the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="daypanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable (shared) folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        shared_dir(spark, "init")
        base = spark.conf.get("spark.checkpoint.dir")
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it: computed once, lineage cut."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
