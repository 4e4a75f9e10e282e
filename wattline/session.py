"""Session construction and shared-storage locations.

All intermediate tables, stream checkpoints and sink folders live under the folder named by
``spark.checkpoint.dir`` (a shared filesystem on a cluster).  A folder is only invented when the
session has none, which is the case in local tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "wattline", cpus: int | str | None = None,
              shuffle_partitions: int | None = None, master: str | None = None) -> SparkSession:
    """Session tuned for the engine: AQE with skew handling, UTC, ANSI on, no UI.

    The master is ``master``, else the one the launcher has set (``spark-submit --master``), else
    ``local[cpus]``.

    ``spark.sql.shuffle.partitions`` is the upper bound AQE coalesces from: on a cluster set it
    to about (largest shuffle size / 128 MB), e.g. 20,000-80,000 for a 100 TB scan, through
    ``WATTLINE_SHUFFLE_PARTITIONS``; locally it defaults to 8."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    parts = shuffle_partitions or int(os.environ.get("WATTLINE_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master or SparkConf().get("spark.master") or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # partitions sized for executor memory: AQE coalesces small shuffle partitions towards
        # the advisory size and splits skewed ones (5x the median and over 256 MB)
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "5")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256MB")
        .config("spark.sql.files.maxPartitionBytes", "128MB")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WATTLINE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a temporary folder, removed when the
    process ends.  On a cluster a folder of the driver's machine would lose rows, so this raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wattline-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for written tables and stream state."""
    return f"{ensure_checkpoint_dir(spark)}/wattline/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: values fixed by the run that wrote
    them stay, and a join with it reads a plain scan, whose partner AQE can split when skewed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
