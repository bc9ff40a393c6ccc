"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", *, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    master, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="panelspark-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no job has written to yet."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def checkpointed(df):
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    directory = shared_dir(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(directory)
    return df.checkpoint(eager=True)


def stored(df, label: str):
    """Write an intermediate table to the shared folder and read it back.

    Used where several parts of a job read the same result: it is computed once,
    survives the loss of executors, and reads keep column pruning and pushdown.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
