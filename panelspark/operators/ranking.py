"""Top rows per group and full rankings.

``row_number() <= k`` needs no care for large groups: Spark keeps only k rows
per key and task before the shuffle (WindowGroupLimit). A full ranking must
order every row of a group, so large groups are cut into ranges of the sort key,
ranked range by range, and shifted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGES = 1000  # of a group at most, so that its cut points are a short list
SAMPLES_PER_RANGE = 8


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int = 1, name: str | None = None) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", name) if name else ranked.drop("_rn")


def nulls_last(col: str) -> list[Column]:
    """Ascending keys that sort NULL after every value."""
    return [F.col(col).isNull(), F.coalesce(F.col(col), F.lit(0.0))]


def newest_first(col: str) -> Column:
    return -F.unix_micros(F.col(col).cast("timestamp"))


def with_row_number(df: DataFrame, by: list[str], ascending: list[Column], name: str, smallest_split: int = 100_000) -> DataFrame:
    """Number the rows of each group by the given ascending keys, which are unique within a group.

    Groups of more than ``smallest_split`` rows are cut into ranges of about that many, at
    most RANGES of them, by cut points from a hash sample of their keys; the ranges are
    numbered in parallel and shifted by the rows before them. The sample decides only
    where ranges begin, every row is numbered. Sizes, cut points and shifts are parts of
    one plan, without a job of their own, and a NULL group is one like others.
    """
    group = by or ["_all"]
    keyed = df if by else df.withColumn("_all", F.lit(0))
    keyed = keyed.withColumn("_key", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(ascending)]))

    def beside(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
        named = right.withColumnsRenamed({c: f"_of_{c}" for c in on})
        same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on))
        return left.join(named, same, how).drop(*(f"_of_{c}" for c in on))

    sizes = keyed.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > smallest_split)
    wanted = F.least(F.ceil(F.col("_n") / smallest_split), F.lit(RANGES)) * SAMPLES_PER_RANGE
    lucky = F.pmod(F.xxhash64("_key"), F.greatest(F.floor(F.col("_n") / wanted), F.lit(1)).cast("long")) == 0
    sample = beside(keyed.select(*group, "_key"), sizes, group, "inner").filter(lucky)
    every = F.expr(f"filter(_sample, (k, i) -> i % {SAMPLES_PER_RANGE} = 0)")
    cuts = sample.groupBy(*group).agg(F.sort_array(F.collect_list("_key")).alias("_sample")).select(*group, every.alias("_cuts"))

    def in_ranges(rows: DataFrame, how: str) -> DataFrame:
        before = F.size(F.filter("_cuts", lambda c: c <= F.col("_key")))
        # a group without cut points is one range
        return beside(rows, cuts, group, how).withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(before)).drop("_cuts")

    counts = in_ranges(keyed.select(*group, "_key"), "inner").groupBy(*group, "_range").count()
    earlier = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(*group, "_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_shift"))
    within = F.row_number().over(W.partitionBy(*group, "_range").orderBy("_key"))
    numbered = beside(in_ranges(keyed, "left").withColumn("_within", within), shifts, [*group, "_range"], "left")
    return numbered.withColumn(name, (F.col("_within") + F.coalesce("_shift", F.lit(0))).cast("int")).select(*df.columns, name)


def chunked(df: DataFrame, order: list[str], size: int, chunk: str) -> DataFrame:
    """Number consecutive chunks of ``size`` rows in the given total order."""
    numbered = with_row_number(df, [], [F.col(c) for c in order], "_pos")
    return numbered.withColumn(chunk, F.floor((F.col("_pos") - 1) / size).cast("int")).drop("_pos")
