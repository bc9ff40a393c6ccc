"""From monthly observations and several sources to one value per year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.guarded import integer_or_null, number_or_null
from .ranking import top_per_group


def annual_mean(points: DataFrame, series: str, date: str, value: str) -> DataFrame:
    """Mean of the known values of each series and calendar year."""
    return points.groupBy(series, F.year(date).alias("year")).agg(F.avg(value).alias("value"))


def annual_preferred(points: DataFrame, series: str = "series_id") -> DataFrame:
    """Published annual values where a series has any, else the mean of its months.

    The choice is made per series: a series with one annual value yields no
    year without one. The yearly sums are combined before the shuffle, so the
    choice is made on a few rows per series.
    """
    annual = F.col("period") == codes.ANNUAL_PERIOD
    number = number_or_null(F.col("value"))
    yearly = points.groupBy(series, integer_or_null(F.col("year")).alias("year")).agg(
        F.max(annual).alias("published"),
        F.max(F.when(annual, number)).alias("annual_value"),
        F.avg(number).alias("mean_value"),
    )
    has_annual = F.max("published").over(W.partitionBy(series))
    return (
        yearly.withColumn("has_annual", has_annual)
        .filter(~F.col("has_annual") | F.col("published"))
        .select(series, "year", F.when(F.col("has_annual"), F.col("annual_value")).otherwise(F.col("mean_value")).alias("value"))
    )


def decoded_series(annual: DataFrame, series: str = "series_id", value: str = "unrate") -> DataFrame:
    """Area type and code from the series id; ids of unknown kinds are dropped."""
    return annual.select(
        codes.series_area_code(F.col(series)).alias("geo_code"),
        codes.series_area_type(F.col(series)).alias("geo_type"),
        "year",
        F.col("value").alias(value),
    ).filter(F.col("geo_type").isNotNull())


def stage_rollup(staged: DataFrame, value: str = "unrate") -> DataFrame:
    return staged.groupBy("geo_code", "year").agg(F.min("geo_type").alias("geo_type"), F.avg(value).alias(value))


def choose_canonical(rows: DataFrame) -> DataFrame:
    """One source per area and year: ACS5 first for counties, ACS1 for the rest."""
    preferred = F.when(F.col("geo_type") == "county", "ACS5").otherwise("ACS1")
    return top_per_group(rows, ["geo_code", "year"], [F.col("source") != preferred, F.col("source")])


def extract_profile(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("geo_type") == "state").alias("states"),
        F.count_if(F.col("geo_type") == "county").alias("counties"),
        F.countDistinct("geo_code").alias("areas"),
    )
