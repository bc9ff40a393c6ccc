"""Landed documents to staged rows to core tables.

Every step is a DataFrame; ``CoreTables`` holds the three core tables before or
after a batch, and ``publish_batch`` writes what a batch changed as new
snapshots. Indicators have one snapshot per code, and a merge reads only the
codes it changes, so a nightly batch costs as much as its own indicator.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions.guarded import number_or_null
from ..operators.annual import annual_mean, annual_preferred, choose_canonical, decoded_series, stage_rollup
from ..operators.panel import union_all
from ..operators.quality import INDEX_RULES, POPULATION_RULES, RATE_RULES, split_by_rules, validation_report
from ..operators.upsert import append_if_absent, one_per_key, upsert
from ..session import stored
from ..sources.audit import record_calls
from ..sources.documents import ORDINAL, latest_points
from ..sources.snapshots import path_exists, publish, read_snapshot
from .features import POPULATION
from .refresh import apply_facts

GEOGRAPHY_SCHEMA = T.StructType(
    [
        T.StructField("geo_code", T.StringType()),
        T.StructField("geo_name", T.StringType()),
        T.StructField("geo_type", T.StringType()),
    ]
)
POPULATION_SCHEMA = T.StructType(
    [
        T.StructField("geo_code", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("population", T.LongType()),
    ]
)
INDICATOR_SCHEMA = T.StructType(
    [
        T.StructField("geo_code", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("indicator_code", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("etl_batch_id", T.StringType()),
    ]
)
CODE_SCHEMA = T.StructType([T.StructField("indicator_code", T.StringType())])
INDICATOR_KEYS = ["geo_code", "year", "indicator_code"]
STORED_CODES = [codes.BASELINE_POPULATION, *codes.SURVEY_INDICATORS.values(), codes.UNEMPLOYMENT, codes.SHELTER_PRICES]


@dataclass(frozen=True)
class CoreTables:
    geography: DataFrame
    population: DataFrame
    indicators: DataFrame


@dataclass(frozen=True)
class Batch:
    core: CoreTables
    staged: DataFrame | None
    report: DataFrame | None
    changed_codes: list[str]
    rejected: DataFrame | None = None
    name: str | None = None
    raw: tuple[str, DataFrame, list[str]] | None = None  # source, rows with their batch, keys
    facts: DataFrame | None = None  # rows of core tables that the feature matrix may need


def empty_core(spark: SparkSession) -> CoreTables:
    return CoreTables(
        spark.createDataFrame([], GEOGRAPHY_SCHEMA),
        spark.createDataFrame([], POPULATION_SCHEMA),
        spark.createDataFrame([], INDICATOR_SCHEMA),
    )


def _listed_codes(spark: SparkSession, root: str) -> list[str]:
    """Codes that batches have published; one row for each indicator, so few."""
    return [row["indicator_code"] for row in read_snapshot(spark, f"{root}/indicator_codes", CODE_SCHEMA).collect()]


def read_core(spark: SparkSession, root: str) -> CoreTables:
    """Current core tables. The code of each indicator snapshot is a literal, so
    a filter on codes leaves the other snapshots unread."""
    parts = [
        read_snapshot(spark, f"{root}/indicators/{code}", INDICATOR_SCHEMA)
        .withColumn("indicator_code", F.lit(code))
        .select(*INDICATOR_SCHEMA.names)
        for code in sorted({*STORED_CODES, *_listed_codes(spark, root)})
    ]
    return CoreTables(
        read_snapshot(spark, f"{root}/geography", GEOGRAPHY_SCHEMA),
        read_snapshot(spark, f"{root}/population", POPULATION_SCHEMA),
        union_all(parts),
    )


def _last(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of several rows for a key the one that landed last, if the source says so."""
    return one_per_key(rows, keys, ORDINAL, last=True).drop(ORDINAL) if ORDINAL in rows.columns else rows


def _raw(rows: DataFrame, batch: str) -> DataFrame:
    return rows.withColumn("etl_batch_id", F.lit(batch))


def append_raw(spark: SparkSession, root: str, source: str, rows: DataFrame, keys: list[str]) -> None:
    """Append raw rows whose keys their batch does not have yet; the first row of a key stays.

    The batch is part of a row's identity and a folder of the table, so that only the
    batch's own rows are read again.
    """
    path = f"{root}/raw/{source}"
    order = ORDINAL if ORDINAL in rows.columns else None
    fresh = one_per_key(rows, ["etl_batch_id", *keys], order, last=False).drop(ORDINAL)
    if path_exists(spark, path):
        batches = [r[0] for r in rows.select("etl_batch_id").distinct().collect()]  # those of one publication
        known = spark.read.schema(fresh.schema).parquet(path).filter(F.col("etl_batch_id").isin(batches))
        fresh = append_if_absent(known, fresh, ["etl_batch_id", *keys]).select(*fresh.columns)
    fresh.write.mode("append").partitionBy("etl_batch_id").parquet(path)


def publish_batch(
    before: CoreTables,
    batch: Batch,
    root: str,
    *,
    calls: DataFrame | None = None,
    regions: DataFrame | None = None,
    floor_year: int = 2005,
) -> None:
    """Write what a batch landed, staged, rejected and reported, then the tables and codes it changed, then the features.

    Raw rows and the log of calls (``calls``, if the collector gives them) only grow;
    stage, quarantine and report are folders of the batch. A rerun of the batch replaces
    those and changes nothing else. The feature matrix below ``features`` is brought up
    to date for the areas that the batch changed.
    """
    after = batch.core
    spark = after.indicators.sparkSession
    if calls is not None:
        record_calls(spark, f"{root}/calls", calls)
    if batch.raw is not None:
        append_raw(spark, root, *batch.raw)
    if batch.name is not None:
        parts = {"stage": batch.staged, "quarantine": batch.rejected, "report": batch.report}
        for kind, rows in parts.items():
            if rows is not None:
                rows.write.mode("overwrite").parquet(f"{root}/{kind}/{batch.name}")
    new = sorted(set(batch.changed_codes) - {*STORED_CODES, *_listed_codes(spark, root)})
    if new:
        codes_ = [(code,) for code in [*_listed_codes(spark, root), *new]]
        publish(spark.createDataFrame(codes_, CODE_SCHEMA), f"{root}/indicator_codes")
    if after.geography is not before.geography:
        publish(after.geography, f"{root}/geography")
    if after.population is not before.population:
        publish(after.population, f"{root}/population", sort_by=["geo_code", "year"])
    for code in batch.changed_codes:
        rows = after.indicators.filter(F.col("indicator_code") == code)
        publish(rows, f"{root}/indicators/{code}", sort_by=["geo_code", "year"])
    if batch.facts is not None:
        apply_facts(spark, f"{root}/features", batch.facts, regions, floor_year)


def _facts(people: DataFrame | None, indicators: DataFrame | None) -> DataFrame:
    """Core rows as facts of the feature matrix."""
    parts = []
    if people is not None:
        parts.append(people.select("geo_code", "year", F.lit(POPULATION).alias("indicator_code"), F.col("population").cast("double").alias("value")))
    if indicators is not None:
        parts.append(indicators.select("geo_code", "year", "indicator_code", F.col("value").cast("double").alias("value")))
    return union_all(parts)


def merge_indicators(stored: DataFrame, rows: DataFrame, changed_codes: list[str], *, full: bool = False) -> DataFrame:
    """Indicator upsert of the given codes; the others pass through untouched.

    Loaders refresh value and batch only; the full form every column.
    """
    touched = F.col("indicator_code").isin(changed_codes)
    update_cols = None if full else ["value", "etl_batch_id"]
    merged = upsert(stored.filter(touched), rows.filter(touched), INDICATOR_KEYS, update_cols=update_cols)
    return stored.filter(~touched).unionByName(merged)


def scan_batch(staged: DataFrame, batch: str) -> DataFrame:
    return staged.filter(F.col("etl_batch_id") == batch)


def _areas(rows: DataFrame) -> DataFrame:
    """One name per area: the one of its latest year."""
    return rows.groupBy("geo_code").agg(
        F.max_by("geo_name", "year").alias("geo_name"), F.max_by("geo_type", "year").alias("geo_type")
    )


def load_surveys(core: CoreTables, staged: DataFrame, rows: DataFrame, batch: str) -> Batch:
    """Population rows of one or two surveys: canonical facts plus one mirror per survey."""
    landed = stored(rows, "surveys")  # landed text is parsed once for raw rows, facts, mirrors, areas, stage and report
    rows, rejected = split_by_rules(landed.filter(F.col("population").isNotNull()), POPULATION_RULES)
    rows = _last(rows, ["geo_code", "year", "source"])
    canonical = choose_canonical(rows)
    mirrors = rows.select(
        "geo_code",
        "year",
        codes.survey_indicator(F.col("source")).alias("indicator_code"),
        F.col("population").cast("double").alias("value"),
        "source",
        F.lit("count").alias("unit"),
        F.lit(batch).alias("etl_batch_id"),
    )
    mirror_codes = list(codes.SURVEY_INDICATORS.values())
    stage_rows = rows.withColumn("etl_batch_id", F.lit(batch))
    report = validation_report(canonical, "acs", "population", "population", "geo_code").withColumn("part", F.lit("core"))
    report = report.unionByName(
        validation_report(rows, "acs", "population", "population", "geo_code").withColumn("part", F.lit("all_iv"))
    )
    return Batch(
        CoreTables(
            upsert(core.geography, _areas(canonical), ["geo_code"]),
            upsert(core.population, canonical.select("geo_code", "year", "population"), ["geo_code", "year"]),
            merge_indicators(core.indicators, mirrors, mirror_codes),
        ),
        upsert(staged, stage_rows, ["geo_code", "year", "source"]) if staged is not None else stage_rows,
        report,
        mirror_codes,
        rejected,
        f"surveys-{batch}",
        ("survey_rows", _raw(landed, batch), ["source", "year", "geo_code"]),
        _facts(canonical, None),
    )


def load_unemployment(core: CoreTables, points: DataFrame, batch: str) -> Batch:
    """State and county unemployment from monthly or annual points.

    Years that cannot be read, or whose values are all missing, never reach the
    core tables.
    """
    landed = stored(points, "points")
    points = _last(landed, ["series_id", "year", "period"])
    staged = decoded_series(annual_preferred(points)).withColumn("etl_batch_id", F.lit(batch))
    rates = stage_rollup(scan_batch(staged, batch)).filter(F.col("unrate").isNotNull() & F.col("year").isNotNull())
    rates, rejected = split_by_rules(rates.withColumn("value", F.col("unrate")), RATE_RULES)
    areas = rates.select("geo_code", F.col("geo_code").alias("geo_name"), "geo_type").distinct()
    rows = rates.select(
        "geo_code",
        "year",
        F.lit(codes.UNEMPLOYMENT).alias("indicator_code"),
        F.col("unrate").alias("value"),
        F.lit("BLS").alias("source"),
        F.lit("percent").alias("unit"),
        F.lit(batch).alias("etl_batch_id"),
    )
    return Batch(
        replace(
            core,
            geography=upsert(core.geography, areas, ["geo_code"], on_conflict="ignore"),
            indicators=merge_indicators(core.indicators, rows, [codes.UNEMPLOYMENT]),
        ),
        staged,
        validation_report(staged, "bls", "unrate", "rate", "geo_code"),
        [codes.UNEMPLOYMENT],
        rejected,
        f"unemployment-{batch}",
        ("points", _raw(landed, batch), ["series_id", "year", "period"]),
        _facts(None, rows),
    )


def _nation_row(like: DataFrame) -> DataFrame:
    """The nation's geography row when a batch has rows."""
    return like.limit(1).select(
        F.lit(codes.NATION).alias("geo_code"), F.lit(codes.NATION_NAME).alias("geo_name"), F.lit("nation").alias("geo_type")
    )


def load_national_unemployment(core: CoreTables, points: DataFrame, batch: str) -> Batch:
    landed = stored(points, "points")
    points = _last(landed, ["series_id", "year", "period"])
    staged = annual_preferred(points).withColumn("etl_batch_id", F.lit(batch))
    good, rejected = split_by_rules(staged.filter(F.col("value").isNotNull() & F.col("year").isNotNull()), RATE_RULES)
    rows = good.select(
        F.lit(codes.NATION).alias("geo_code"),
        "year",
        F.lit(codes.UNEMPLOYMENT).alias("indicator_code"),
        "value",
        F.lit("BLS").alias("source"),
        F.lit("percent").alias("unit"),
        F.lit(batch).alias("etl_batch_id"),
    )
    return Batch(
        replace(
            core,
            geography=upsert(core.geography, _nation_row(rows), ["geo_code"], on_conflict="ignore"),
            indicators=merge_indicators(core.indicators, rows, [codes.UNEMPLOYMENT]),
        ),
        staged,
        validation_report(staged, "bls-cps-us", "value", "rate", None),
        [codes.UNEMPLOYMENT],
        rejected,
        f"national-{batch}",
        ("points", _raw(landed, batch), ["series_id", "year", "period"]),
        _facts(None, rows),
    )


def load_prices(core: CoreTables, observations: DataFrame, batch: str) -> Batch:
    """Yearly shelter price index of the nation and regions; other series stay staged only."""
    landed = stored(observations, "observations")
    numbered = _last(landed, ["series_id", "obs_date"]).withColumn("number", number_or_null(F.col("raw_value")))
    staged = annual_mean(numbered, "series_id", "obs_date", "number").withColumn("etl_batch_id", F.lit(batch))
    placed = staged.withColumns(
        {
            "geo_code": codes.price_area_code(F.col("series_id")),
            "geo_name": codes.price_area_name(F.col("series_id")),
        }
    ).filter(F.col("geo_code").isNotNull() & F.col("value").isNotNull() & F.col("year").isNotNull())
    placed, rejected = split_by_rules(placed, INDEX_RULES)
    areas = placed.select("geo_code", "geo_name", codes.price_area_type(F.col("geo_code")).alias("geo_type")).distinct()
    rows = placed.select(
        "geo_code",
        "year",
        F.lit(codes.SHELTER_PRICES).alias("indicator_code"),
        "value",
        F.lit("FRED").alias("source"),
        F.lit("index").alias("unit"),
        F.lit(batch).alias("etl_batch_id"),
    )
    return Batch(
        replace(
            core,
            geography=upsert(core.geography, areas, ["geo_code"], on_conflict="ignore"),
            indicators=merge_indicators(core.indicators, rows, [codes.SHELTER_PRICES]),
        ),
        staged,
        validation_report(staged, "fred", "value", "CPI value", None, empty="no observations"),
        [codes.SHELTER_PRICES],
        rejected,
        f"prices-{batch}",
        ("observations", _raw(landed, batch), ["series_id", "obs_date"]),
        _facts(None, rows),
    )


def load_baseline(core: CoreTables, population: DataFrame, rate_docs: DataFrame, batch: str) -> Batch:
    """One survey population of the nation and the latest unemployment rate, under the same rules as the other loads."""
    people, bad_people = split_by_rules(
        population.filter((F.col("geo_code") == codes.NATION) & F.col("population").isNotNull()), POPULATION_RULES
    )
    people = _last(people, ["geo_code", "year"]).select("geo_code", "year", "population")
    people_rows = people.select(
        "geo_code",
        "year",
        F.lit(codes.BASELINE_POPULATION).alias("indicator_code"),
        F.col("population").cast("double").alias("value"),
        F.lit("ACS").alias("source"),
        F.lit("count").alias("unit"),
        F.lit(batch).alias("etl_batch_id"),
    )
    rates, bad_rates = split_by_rules(latest_points(rate_docs).filter(F.col("value").isNotNull()), RATE_RULES)
    rate_rows = rates.select(
        F.lit(codes.NATION).alias("geo_code"),
        "year",
        F.lit(codes.UNEMPLOYMENT).alias("indicator_code"),
        "value",
        F.lit("BLS").alias("source"),
        F.lit("percent").alias("unit"),
        F.lit(batch).alias("etl_batch_id"),
    )
    changed = [codes.BASELINE_POPULATION, codes.UNEMPLOYMENT]
    staged = people_rows.unionByName(rate_rows)
    after = replace(
        core,
        population=upsert(core.population, people, ["geo_code", "year"]),
        indicators=merge_indicators(core.indicators, staged, changed, full=True),
    )
    rejected = bad_people.select("geo_code", "year", F.col("population").cast("double").alias("value"), "broken_rules").unionByName(
        bad_rates.select(F.lit(codes.NATION).alias("geo_code"), "year", "value", "broken_rules")
    )
    report = validation_report(staged, "baseline", "value", "value", "geo_code")
    return Batch(after, staged, report, changed, rejected, f"baseline-{batch}", None, _facts(people, rate_rows))
