"""Pick up newly landed documents and merge them into the core tables.

The nightly run processes what has landed since the last one and stops. The
file source remembers handled files in its checkpoint; merges are idempotent,
so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ingest import Batch, CoreTables, load_unemployment, publish_batch, read_core
from ..sources.buckets import prepare_merge, publish_merge
from ..sources.documents import series_points

Loader = Callable[[CoreTables, DataFrame, str], Batch]
POINT_KEYS = ["series_id", "year", "period"]


def ingest_landed(
    spark: SparkSession, landing: str, core_root: str, checkpoint: str, *, batch_prefix: str, load: Loader = load_unemployment, **publishing
) -> None:
    """Handle every document that landed since the last run, then stop.

    All points of all runs are kept, below ``points``, in buckets of series. A batch merges its
    points there and hands every point of the series it changed to the loader, so a
    year whose months arrive in several runs has the mean of all of them, and a
    published annual value counts whenever it came. Points are published last: a batch
    that dies before is replayed with the same outcome.
    """

    def merge(docs: DataFrame, epoch: int) -> None:
        points = series_points(docs.withColumnRenamed("value", "doc"))[0].select(*POINT_KEYS, "value")
        known = prepare_merge(spark, f"{core_root}/points", points, POINT_KEYS, points.schema, key="series_id")
        series = known.changed.select("series_id").distinct()
        whole = known.rows.join(series, "series_id", "left_semi").filter(F.col("value").isNotNull())
        before = read_core(spark, core_root)
        publish_batch(before, load(before, whole, f"{batch_prefix}_{epoch}"), core_root, **publishing)
        publish_merge(known, POINT_KEYS, "series_id")

    query = (
        spark.readStream.format("text")
        .load(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
