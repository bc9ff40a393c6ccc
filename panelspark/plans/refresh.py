"""The feature matrix kept up to date: only what a batch changes is computed and written again.

Facts and matrix are tables in buckets of areas. A changed fact changes the features of
its area's later years (lags, averages, the year features become complete), so an area
is the smallest part that is always right to recompute; its rows are bounded by the
calendar. Prices of the nation or a region also change the areas that fall back on them.
Hashes of the matrix's blocks of years are kept beside it, for the areas recomputed only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..operators.hashtree import leaf_hashes
from ..session import stored
from ..sources.buckets import BUCKETS, bucket_of, current_folders, prepare_merge, publish_buckets, publish_merge, read_buckets, touched
from .features import HASHED_COLUMNS, MATRIX_COLUMNS, POPULATION, fallback_areas, matrix_from_facts, with_region

FACT_KEYS = ["geo_code", "year", "indicator_code"]
FACT_SCHEMA = T.StructType(
    [
        T.StructField("geo_code", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("indicator_code", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
MATRIX_SCHEMA = T.StructType(
    [T.StructField("geo_code", T.StringType()), T.StructField("year", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in MATRIX_COLUMNS[2:-1]]
    + [T.StructField("has_full_features", T.BooleanType())]
)
LEAF_SCHEMA = T.StructType(
    [
        T.StructField("geo_code", T.StringType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("leaf", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("full_rows", T.LongType()),
    ]
)


def affected_areas(facts: DataFrame, changed: DataFrame, regions: DataFrame | None) -> DataFrame:
    """Areas whose features may differ after the changed facts.

    ``facts`` are all of them; areas are looked up there only for prices of the nation
    and the regions, and only by area, year and kind.
    """
    own = changed.select("geo_code")
    prices = changed.filter(F.col("indicator_code") == codes.SHELTER_PRICES)
    shared = prices.join(F.broadcast(fallback_areas(prices, regions)), "geo_code", "left_semi").select(F.col("geo_code").alias("source"), "year").distinct()
    people = with_region(facts.filter(F.col("indicator_code") == POPULATION).select("geo_code", "year"), regions)
    priced = facts.filter(F.col("indicator_code") == codes.SHELTER_PRICES).select("geo_code", "year")
    without = people.join(priced, ["geo_code", "year"], "left_anti")
    offered = without.withColumn("source", F.explode(F.array(F.col("region"), F.lit(codes.NATION))))
    return own.unionByName(offered.join(shared, ["source", "year"], "left_semi").select("geo_code")).distinct()


def publish_leaves(spark: SparkSession, root: str, areas: DataFrame, buckets: list[int]) -> None:
    """Hash the blocks of the given areas, which lie in ``buckets``, from the published matrix.

    Other areas of these buckets keep their leaves. Buckets of a matrix that has no leaves
    yet are hashed whole.
    """
    known = current_folders(spark, f"{root}/leaves")[1]
    bare = [b for b in current_folders(spark, f"{root}/matrix")[1] if b not in known]
    wanted = sorted({*buckets, *bare})
    rows = read_buckets(spark, f"{root}/matrix", MATRIX_SCHEMA, wanted)
    due = rows.filter(bucket_of().isin(bare)).unionByName(
        rows.filter(~bucket_of().isin(bare)).join(areas, "geo_code", "left_semi")
    )
    fresh = leaf_hashes(due, "geo_code", "year", HASHED_COLUMNS, full=F.col("has_full_features")).select(*LEAF_SCHEMA.names)
    kept = read_buckets(spark, f"{root}/leaves", LEAF_SCHEMA, buckets).join(areas, "geo_code", "left_anti")
    publish_buckets(kept.unionByName(fresh), f"{root}/leaves", wanted, sort_by=["geo_code", "block"])


def read_leaves(spark: SparkSession, root: str) -> DataFrame:
    """Hashes of all areas' blocks of years, as ``operators.hashtree`` and the training plan take them."""
    return read_buckets(spark, f"{root}/leaves", LEAF_SCHEMA)


def apply_facts(
    spark: SparkSession, root: str, updates: DataFrame, regions: DataFrame | None = None, floor_year: int = 2005, order: str | None = None
) -> list[int]:
    """Merge facts (geo_code, year, indicator_code, value) below ``root`` and refresh the matrix.

    Returns the matrix buckets that were written. Of several rows for a key the last by
    ``order`` counts. Matrix and leaves are published first: a job that dies between leaves the
    facts as they were, so the next run finds the same changes and writes the same rows.
    """
    merge = prepare_merge(spark, f"{root}/facts", stored(updates, "updates"), FACT_KEYS, FACT_SCHEMA, order=order)
    others = [b for b in range(BUCKETS) if b not in merge.buckets]
    facts = read_buckets(spark, f"{root}/facts", FACT_SCHEMA, others).unionByName(merge.rows)
    areas = stored(affected_areas(facts, merge.changed, regions), "areas")
    buckets = touched(areas)
    if buckets:
        # of other buckets only the folders that are needed are read for the areas
        near = [b for b in buckets if b not in merge.buckets]
        own = read_buckets(spark, f"{root}/facts", FACT_SCHEMA, near).unionByName(merge.rows.filter(bucket_of().isin(buckets)))
        matrix = matrix_from_facts(own, facts, regions, floor_year).select(*MATRIX_COLUMNS)
        publish_buckets(matrix, f"{root}/matrix", buckets, sort_by=["geo_code", "year"])
        publish_leaves(spark, root, areas, buckets)
    publish_merge(merge, FACT_KEYS)
    return buckets


def read_matrix(spark: SparkSession, root: str, areas: list[str] | None = None) -> DataFrame:
    """The refreshed matrix; of named areas only their buckets are read."""
    if areas is None:
        return read_buckets(spark, f"{root}/matrix", MATRIX_SCHEMA)
    named = spark.createDataFrame([(a,) for a in areas], "geo_code string")
    return read_buckets(spark, f"{root}/matrix", MATRIX_SCHEMA, touched(named)).filter(F.col("geo_code").isin(areas))
