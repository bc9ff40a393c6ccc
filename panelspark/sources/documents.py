"""Landed API responses as rows.

Documents arrive as text, one per line or one per file. They are parsed with
explicit schemas in permissive mode, so a bad document never stops a job: it
goes to the rejected side with a reason. A response holds at most one request
batch of series, or one table, so single documents stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions.guarded import date_or_null, integer_or_null

SERIES_SCHEMA = (
    "status string, Results struct<series: array<struct<seriesID: string,"
    " data: array<struct<year: string, period: string, value: string>>>>>, _corrupt string"
)
OBSERVATIONS_SCHEMA = "observations array<struct<date: string, value: string>>, _corrupt string"
TABLE_SCHEMA = "array<array<string>>"

EMPTY_ROWS = T.StructType(
    [
        T.StructField("geo_code", T.StringType()),
        T.StructField("geo_name", T.StringType()),
        T.StructField("geo_type", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("population", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)


#: Where a document comes from, in the order in which documents landed.
ORIGIN, ORDINAL = "origin", "ordinal"


def read_documents(spark: SparkSession, path: str, whole_file: bool = False, origin: bool = False) -> DataFrame:
    """Column ``doc`` plus any partition columns of the folder.

    With ``origin`` each document also says where it is from: its file's time and name,
    the block of the file, and its place among the block's documents. Rows parsed from
    it then carry an ``ordinal``, by which a later row replaces an earlier one wherever
    a shuffle has put them.
    """
    docs = spark.read.text(path, wholetext=whole_file)
    if origin:
        file = "_metadata.file_"
        parts = [F.col(f"{file}modification_time"), F.col(f"{file}path"), F.col(f"{file}block_start")]
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")
        names = ("landed", "file", "block")
        docs = docs.withColumn(ORIGIN, F.struct(*(p.alias(n) for p, n in zip(parts, names)), place))
    return docs.withColumnRenamed("value", "doc")


def _ordinal(docs: DataFrame, *places: str) -> list[Column]:
    """The ordinal of a row at the given places within its document, if documents say where they are from."""
    return [F.struct(ORIGIN, *places).alias(ORDINAL)] if ORIGIN in docs.columns else []


def _split(parsed: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    checked = parsed.withColumn("reason", reason)
    return checked.filter(F.col("reason").isNull()).drop("reason"), checked.filter(F.col("reason").isNotNull())


def _without_parsed(bad: DataFrame) -> DataFrame:
    return bad.drop("parsed", "header")


def series_points(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points (series_id, year, period, value) of succeeded responses; the others."""
    parsed = docs.withColumn("parsed", F.from_json("doc", SERIES_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"}))
    reason = (
        F.when(F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull(), "not a response document")
        .when(~F.col("parsed.status").eqNullSafe(F.lit(codes.REQUEST_OK)), "request failed")
    )
    good, bad = _split(parsed, reason)
    kept = [c for c in docs.columns if c not in ("doc", ORIGIN)]
    origin = [c for c in docs.columns if c == ORIGIN]
    series = good.select(*kept, *origin, F.posexplode("parsed.Results.series").alias("i", "s"))
    each = series.select(*kept, *origin, "i", F.col("s.seriesID").alias("series_id"), F.posexplode("s.data").alias("j", "o"))
    points = each.select(
        *kept,
        "series_id",
        integer_or_null(F.col("o.year")).alias("year"),
        F.col("o.period").alias("period"),
        F.col("o.value").alias("value"),
        *_ordinal(docs, "i", "j"),
    )
    return points, _without_parsed(bad)


def latest_points(docs: DataFrame) -> DataFrame:
    """First listed observation of each series, the newest one in a response."""
    parsed = docs.select(F.from_json("doc", SERIES_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"}).alias("parsed"))
    series = parsed.filter(F.col("parsed.status") == codes.REQUEST_OK).select(F.explode("parsed.Results.series").alias("s"))
    first = F.try_element_at("s.data", F.lit(1))
    return series.select(
        F.col("s.seriesID").alias("series_id"),
        integer_or_null(first["year"]).alias("year"),
        first["value"].try_cast("double").alias("value"),
    ).filter(F.col("year").isNotNull())


def table_rows(docs: DataFrame, level: str, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of header-first tables, columns found by their header name.

    ``level`` is nation, state or county. Documents carry ``year`` and
    ``survey`` columns. A document that is no table or lacks a required column
    is rejected as a whole.
    """
    needed = required or {
        "nation": [codes.NAME_VARIABLE, codes.POPULATION_VARIABLE],
        "state": [codes.NAME_VARIABLE, codes.POPULATION_VARIABLE, "state"],
        "county": [codes.NAME_VARIABLE, codes.POPULATION_VARIABLE, "state", "county"],
    }[level]
    parsed = docs.withColumn("parsed", F.from_json("doc", TABLE_SCHEMA)).withColumn(
        "header", F.try_element_at("parsed", F.lit(1))
    )
    absent = F.array_except(F.array(*[F.lit(c) for c in needed]), F.col("header"))
    reason = F.when(F.col("header").isNull(), "not a table").when(
        F.size(absent) > 0, F.concat(F.lit("missing columns: "), F.array_join(absent, ", "))
    )
    good, bad = _split(parsed, reason)

    def cell(name: str) -> Column:
        return F.try_element_at("row", F.nullif(F.array_position("header", F.lit(name)).cast("int"), F.lit(0)))

    area = {
        "nation": F.lit(codes.NATION),
        "state": cell("state"),
        "county": F.concat(cell("state"), cell("county")),
    }[level]
    below = F.slice("parsed", F.lit(2), F.greatest(F.size("parsed") - 1, F.lit(0)))
    body = good.select("*", F.posexplode(below).alias("i", "row"))
    rows = body.select(
        area.alias("geo_code"),
        cell(codes.NAME_VARIABLE).alias("geo_name"),
        F.lit(level).alias("geo_type"),
        F.col("year").cast("int").alias("year"),
        cell(codes.POPULATION_VARIABLE).try_cast("bigint").alias("population"),
        F.upper("survey").alias("source"),
        *_ordinal(docs, "i"),
    )
    return rows, _without_parsed(bad)


def observations(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations (series_id, obs_date, raw_value); documents carry ``series_id``."""
    parsed = docs.withColumn("parsed", F.from_json("doc", OBSERVATIONS_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"}))
    reason = F.when(
        F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull() | F.col("parsed.observations").isNull(),
        "no observations",
    )
    good, bad = _split(parsed, reason)
    origin = [c for c in docs.columns if c == ORIGIN]
    rows = good.select("series_id", *origin, F.posexplode("parsed.observations").alias("i", "o")).select(
        "series_id", date_or_null(F.col("o.date")).alias("obs_date"), F.col("o.value").alias("raw_value"), *_ordinal(docs, "i")
    )
    return rows, _without_parsed(bad)
