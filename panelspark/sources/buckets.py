"""Tables cut into buckets of areas, so that a small batch reads and writes few files.

A bucket is a folder with a version of its own. A publication writes new folders for
the buckets that it changes and then one manifest that names them; the others keep
their files, and readers see either none of the new folders or all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import upsert
from ..session import stored
from .snapshots import claim, path_exists

#: Buckets of a table. They are listed on the driver, so there are few.
BUCKETS = 16
MANIFEST = T.StructType(
    [T.StructField("sequence", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("version", T.StringType())]
)


def bucket_of(key: str = "geo_code") -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def touched(rows: DataFrame, key: str = "geo_code") -> list[int]:
    """Numbers of the buckets that rows fall in; at most BUCKETS."""
    return sorted(r.bucket for r in rows.select(bucket_of(key).alias("bucket")).distinct().collect())


def current_folders(spark: SparkSession, root: str) -> tuple[int, dict[int, str]]:
    """(last sequence, bucket -> folder) of what is published; the newest manifest of a bucket counts."""
    if not path_exists(spark, f"{root}/manifest"):
        return 0, {}
    newest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest").groupBy("bucket").agg(F.max(F.struct("sequence", "version")).alias("m"))
    rows = newest.collect()  # at most BUCKETS
    return max((r.m.sequence for r in rows), default=0), {r.bucket: f"{root}/data/{r.m.version}/bucket={r.bucket}" for r in rows}


def read_buckets(spark: SparkSession, root: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """The published rows, of the given buckets alone if they are named."""
    folders = current_folders(spark, root)[1]
    wanted = sorted(folders if buckets is None else set(buckets) & set(folders))
    paths = [folders[b] for b in wanted if path_exists(spark, folders[b])]  # an emptied bucket has no files
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def publish_buckets(
    rows: DataFrame, root: str, buckets: list[int], *, key: str = "geo_code", sort_by: list[str] | None = None, sequence: int | None = None
) -> None:
    """Replace the given buckets by ``rows``, which lie in them.

    ``sequence`` is that of the state the rows were made from: if another writer has
    published since, nothing is published and an error tells so.
    """
    spark = rows.sparkSession
    if not buckets:
        return
    if sequence is None:
        sequence = current_folders(spark, root)[0]
    version = uuid.uuid4().hex
    dealt = rows.withColumn("bucket", bucket_of(key)).repartition(len(buckets), "bucket")
    dealt.sortWithinPartitions("bucket", *(sort_by or [key])).write.partitionBy("bucket").parquet(f"{root}/data/{version}")
    claim(spark, root, sequence + 1)
    manifest = spark.createDataFrame([(sequence + 1, b, version) for b in buckets], MANIFEST)
    manifest.coalesce(1).write.mode("append").parquet(f"{root}/manifest")


@dataclass(frozen=True)
class Merge:
    """A merge that is computed but not published: the rows of the buckets it read, and those that differ from before."""

    root: str
    sequence: int
    buckets: list[int]
    rows: DataFrame
    changed: DataFrame
    dirty: list[int]


def prepare_merge(
    spark: SparkSession, root: str, updates: DataFrame, keys: list[str], schema: T.StructType, *, key: str = "geo_code", **options
) -> Merge:
    """Upsert ``updates`` into the buckets they fall in; the other buckets are not read."""
    buckets = touched(updates, key)
    sequence = current_folders(spark, root)[0]
    before = read_buckets(spark, root, schema, buckets)
    rows = stored(upsert(before, updates, keys, **options), "merged")
    payload = [c for c in schema.names if c not in keys]
    old = before.select(*(F.col(k).alias(f"old_{k}") for k in keys), F.struct(*payload).alias("old"))
    both = rows.join(old, [F.col(k).eqNullSafe(F.col(f"old_{k}")) for k in keys], "left")
    changed = both.filter(F.col("old").isNull() | ~F.col("old").eqNullSafe(F.struct(*payload))).select(*schema.names)
    changed = stored(changed, "changed")
    return Merge(root, sequence, buckets, rows, changed, touched(changed, key))


def publish_merge(merge: Merge, keys: list[str], key: str = "geo_code") -> None:
    """Write the buckets whose rows differ; a replayed merge has none."""
    rows = merge.rows.filter(bucket_of(key).isin(merge.dirty))
    publish_buckets(rows, merge.root, merge.dirty, key=key, sort_by=keys, sequence=merge.sequence)


def merge_buckets(
    spark: SparkSession, root: str, updates: DataFrame, keys: list[str], schema: T.StructType, *, key: str = "geo_code", **options
) -> DataFrame:
    """Upsert ``updates``, publish, and return the rows that are new or have other values."""
    merge = prepare_merge(spark, root, updates, keys, schema, key=key, **options)
    publish_merge(merge, keys, key)
    return merge.changed
