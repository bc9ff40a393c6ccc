"""Table snapshots: write a new version, then point to it.

A version is a partition folder that no reader looks at until its number is
appended to the pointer table. A job that dies half-way leaves the old version
current, and readers never see files that are being replaced.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER_SCHEMA = T.StructType(
    [T.StructField("sequence", T.LongType()), T.StructField("version", T.StringType())]
)


class ConcurrentWrite(RuntimeError):
    """Another writer has published since this one read the table."""


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    at, files = _file_system(spark, path)
    return files.exists(at)


#: After so many milliseconds a number that was taken but never published is free again.
STALE = 6 * 3600 * 1000


def claim(spark: SparkSession, root: str, sequence: int) -> None:
    """Take a sequence number for this writer alone; whoever comes second fails before its version is seen.

    The number of a writer that died before it published is free again after STALE.
    """
    at, files = _file_system(spark, f"{root}/claims/{sequence}")
    files.mkdirs(at.getParent())
    if files.exists(at) and time.time() * 1000 - files.getFileStatus(at).getModificationTime() >= STALE:
        files.delete(at, False)
    try:
        won = files.createNewFile(at)
    except Exception as error:  # some stores raise instead
        raise ConcurrentWrite(f"{root}: version {sequence} is taken") from error
    if not won:
        raise ConcurrentWrite(f"{root}: version {sequence} is taken")


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Newest committed (sequence, version); one row, read by a top-1. None if nothing was ever published."""
    if not path_exists(spark, f"{root}/pointer"):
        return None
    newest = spark.read.schema(POINTER_SCHEMA).parquet(f"{root}/pointer").orderBy(F.desc("sequence")).first()
    return (newest["sequence"], newest["version"]) if newest else None


def read_snapshot(spark: SparkSession, root: str, empty: T.StructType | None = None) -> DataFrame:
    current = current_version(spark, root)
    if current is None:
        if empty is None:
            raise FileNotFoundError(f"no snapshot below {root}")
        return spark.createDataFrame([], empty)
    return spark.read.parquet(f"{root}/data/{current[1]}")


def publish(df: DataFrame, root: str, *, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as the new current version and return it as read back.

    Sorting within files by area and period lets later reads skip row groups. If another
    writer publishes meanwhile, this one fails and may start again from the new version.
    """
    spark = df.sparkSession
    current = current_version(spark, root)
    version = uuid.uuid4().hex
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = out.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/data/{version}")
    sequence = (current[0] if current else 0) + 1
    claim(spark, root, sequence)
    pointer = spark.createDataFrame([(sequence, version)], POINTER_SCHEMA)
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/pointer")
    return spark.read.parquet(f"{root}/data/{version}")
