"""The feature matrix: one row per area and year, ready for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.guarded import all_present, compound_growth_pct, growth_pct
from ..operators.panel import cut_in, with_lags, with_moving_average

FEATURE_COLUMNS = [
    "population",
    "pop_lag1",
    "pop_lag5",
    "pop_ma3",
    "pop_yoy_growth_pct",
    "pop_cagr_5yr_pct",
    "unemployment_rate",
    "rent_cpi_index",
]
MATRIX_COLUMNS = ["geo_code", "year", *FEATURE_COLUMNS, "has_full_features"]
HASHED_COLUMNS = ["year", *FEATURE_COLUMNS]

NOT_REGRESSORS = [
    "geo_code",
    "year",
    "population",
    "pop_ma3",
    "pop_yoy_growth_pct",
    "pop_cagr_5yr_pct",
    "has_full_features",
]
REGRESSORS = ["pop_lag1", "pop_lag5", "unemployment_rate", "rent_cpi_index"]


POPULATION = "population"


def stack_facts(population: DataFrame, indicators: DataFrame) -> DataFrame:
    """Population and the matrix's indicators as one long table."""
    people = population.select(
        "geo_code", "year", F.lit(POPULATION).alias("indicator_code"), F.col("population").cast("double").alias("value")
    )
    wanted = indicators.filter(F.col("indicator_code").isin(codes.UNEMPLOYMENT, codes.SHELTER_PRICES))
    return people.unionByName(wanted.select("geo_code", "year", "indicator_code", F.col("value").cast("double")))


def facts_by_area(facts: DataFrame) -> DataFrame:
    """Population with its own unemployment rate and price index, in one shuffle.

    The long table is spread by area once. Grouping by (area, year) and every
    later window over an area reuse that placement, where one join per
    indicator would move the facts again.
    """

    def value_of(code: str) -> Column:
        return F.max(F.when(F.col("indicator_code") == code, F.col("value")))

    return (
        facts.repartition("geo_code")
        .groupBy("geo_code", "year")
        .agg(
            F.max(F.col("indicator_code") == POPULATION).alias("has_fact"),
            value_of(POPULATION).alias("population"),
            value_of(codes.UNEMPLOYMENT).alias("unemployment_rate"),
            value_of(codes.SHELTER_PRICES).alias("own_index"),
        )
        .filter("has_fact")
        .drop("has_fact")
    )


def fallback_index(indicators: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Price index by year as a map from the nation and the regions.

    One row per year, with an entry for the nation and each region: of the census
    map, or of the given (prefix, region) table, which has at most 100 of them.
    """
    single = indicators.filter((F.col("indicator_code") == codes.SHELTER_PRICES) & F.col("year").isNotNull())
    if regions is None:
        single = single.filter(F.col("geo_code").isin([codes.NATION, *codes.REGION_CODES]))
    else:
        single = single.join(F.broadcast(fallback_areas(single, regions)), "geo_code", "left_semi")
    single = (
        single
        .groupBy("geo_code", "year")
        .agg(F.max(F.col("value").cast("double")).alias("value"))
    )
    return single.groupBy("year").agg(
        F.map_from_entries(F.collect_list(F.struct("geo_code", "value"))).alias("index_by_area")
    )


def fallback_areas(like: DataFrame, regions: DataFrame | None) -> DataFrame:
    """The areas whose prices others fall back on: the nation and at most 100 regions."""
    if regions is None:
        return like.sparkSession.createDataFrame([(c,) for c in [codes.NATION, *codes.REGION_CODES]], "geo_code string")
    named = region_lookup(regions).select(F.col("region").alias("geo_code")).filter(F.col("geo_code").isNotNull())
    return named.unionByName(named.sparkSession.range(1).select(F.lit(codes.NATION).alias("geo_code"))).distinct()


def region_lookup(regions: DataFrame) -> DataFrame:
    """One region for each two-digit prefix: at most 100 rows."""
    return regions.filter(F.col("prefix").rlike(codes.STATE_PATTERN)).groupBy("prefix").agg(F.max("region").alias("region"))


def with_region(df: DataFrame, regions: DataFrame | None) -> DataFrame:
    """Add ``region`` to area codes: the census map, or a (prefix, region) table.

    A prefix has two digits, so a table holds at most 100 rows once it is
    reduced to one row per prefix.
    """
    if regions is None:
        return df.withColumn("region", codes.region_of(F.col("geo_code")))
    prefix = F.when(codes.is_state_or_county(F.col("geo_code")), F.substring("geo_code", 1, 2))
    return df.withColumn("prefix", prefix).join(F.broadcast(region_lookup(regions)), "prefix", "left").drop("prefix")


def joined_features(facts: DataFrame, prices: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Every population fact with its features and completeness flag.

    ``facts`` is the long table of ``stack_facts``; ``prices`` holds the price
    index of the nation and the regions, for areas without their own.
    """
    wide = facts_by_area(facts)
    wide = with_lags(wide, "geo_code", "year", "population", {1: "pop_lag1", 5: "pop_lag5"})
    wide = with_moving_average(wide, "geo_code", "year", "population", 3, "pop_ma3")
    wide = with_region(wide, regions).join(fallback_index(prices, regions), "year", "left")

    value, lag1, lag5 = F.col("population"), F.col("pop_lag1"), F.col("pop_lag5")
    return wide.withColumns(
        {
            "region_index": F.try_element_at("index_by_area", F.col("region")),
            "nation_index": F.try_element_at("index_by_area", F.lit(codes.NATION)),
            "pop_yoy_growth_pct": growth_pct(value, lag1),
            "pop_cagr_5yr_pct": compound_growth_pct(value, lag5, 5),
        }
    ).withColumns(
        {"rent_cpi_index": F.coalesce("own_index", "region_index", "nation_index")}
    ).withColumn("has_full_features", all_present(FEATURE_COLUMNS)).drop("index_by_area")


def matrix_from_facts(
    facts: DataFrame, prices: DataFrame, regions: DataFrame | None = None, floor_year: int = 2005
) -> DataFrame:
    joined = joined_features(facts, prices, regions)
    return cut_in(joined, "geo_code", "year", "has_full_features", floor_year).select(*MATRIX_COLUMNS)


def feature_matrix(
    population: DataFrame, indicators: DataFrame, regions: DataFrame | None = None, floor_year: int = 2005
) -> DataFrame:
    """Complete feature rows, from the year each area's features become complete."""
    return matrix_from_facts(stack_facts(population, indicators), indicators, regions, floor_year)
