"""Session defaults for local use; on a cluster the session comes from spark-submit."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution, UTC time and strict shuffle sizes."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("deltaloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``; a local master may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "deltaloom-checkpoints")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The frame as a checkpoint: its rows and partitions stay as they are, and Spark's cleaner drops the files once nothing reads them.

    That needs ``spark.cleaner.referenceTracking.cleanCheckpoints`` on, as ``local_session`` has it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()
