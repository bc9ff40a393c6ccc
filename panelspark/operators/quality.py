"""Data-quality reports and row rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panel import FIRST_YEAR, LAST_YEAR

POPULATION_RULES = {
    "population_not_negative": lambda: F.col("population") >= 0,
    "year_in_calendar": lambda: F.col("year").between(FIRST_YEAR, LAST_YEAR),
}
RATE_RULES = {"rate_is_percent": lambda: F.col("value").isNull() | F.col("value").between(0, 100)}
INDEX_RULES = {"index_not_negative": lambda: F.col("value").isNull() | (F.col("value") >= 0)}


def broken_rules(rules: dict) -> Column:
    """Names of the rules a row breaks. A rule that yields NULL counts as kept."""
    return F.array_compact(F.array(*[F.when(~rule(), F.lit(name)) for name, rule in rules.items()]))


def split_by_rules(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of broken ones."""
    checked = df.withColumn("broken_rules", broken_rules(rules))
    good = checked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return good, checked.filter(F.size("broken_rules") > 0)


def rule_violations(df: DataFrame, rules: dict) -> DataFrame:
    """Number of rows that break each rule, zero included, in one pass."""
    counts = df.agg(*[F.count_if(~rule()).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("dup_count")).filter(F.col("dup_count") > 1)


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(f"{k}_nulls") for k in keys])


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values without a parent, with their row counts. Counting first leaves
    one row per value, so a frequent value does not weigh on the join."""
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(key), key, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return child.join(parent.select(*keys), keys, "left_anti")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def row_parity(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Two row counts side by side and their difference."""
    a = left.agg(F.count("*").alias(left_name))
    b = right.agg(F.count("*").alias(right_name))
    return a.crossJoin(b).withColumn("gap", F.col(right_name) - F.col(left_name))


def period_span(df: DataFrame, period: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.min(period).alias(f"min_{period}"), F.max(period).alias(f"max_{period}"), F.count("*").alias("rows")
    )


def count_by(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"))


def coverage_by_area_type(indicators: DataFrame, geography: DataFrame, by: list[str]) -> DataFrame:
    """Rows per area type. Rows are counted per area before the join."""
    per_area = count_by(indicators, ["geo_code", *by])
    typed = per_area.join(geography.select("geo_code", "geo_type"), "geo_code")
    return typed.groupBy(*by, "geo_type").agg(F.sum("rows").alias("rows"))


def freshness(indicators: DataFrame) -> DataFrame:
    return indicators.groupBy("indicator_code").agg(
        F.max("year").alias("latest_year"), F.count("*").alias("total_rows")
    )


def known_by_period(df: DataFrame, period: str, cols: dict[str, str]) -> DataFrame:
    return df.groupBy(period).agg(F.count("*").alias("rows"), *[F.count(c).alias(n) for c, n in cols.items()])


def distinct_values(df: DataFrame, col: str, name: str) -> DataFrame:
    """Sorted array of a column's values. For columns with a small closed domain."""
    return df.agg(F.sort_array(F.collect_set(col)).alias(name))


def validation_report(df: DataFrame, source: str, value: str, what: str, area: str | None, empty: str = "no rows") -> DataFrame:
    """Rows, distinct areas, year span and issues of one batch, as one row."""
    areas = F.countDistinct(area) if area else F.lit(None).cast("bigint")
    stats = df.agg(
        F.count("*").alias("rows"),
        areas.alias("geos"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.count_if(F.col(value) < 0).alias("_negative"),
    )
    issues = F.array_compact(
        F.array(
            F.when(F.col("rows") == 0, F.lit(empty)),
            F.when(F.col("_negative") > 0, F.lit(f"negative {what}")),
        )
    )
    return stats.select(F.lit(source).alias("source"), "rows", "geos", "year_min", "year_max", issues.alias("issues"))
