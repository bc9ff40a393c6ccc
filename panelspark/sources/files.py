"""CSV and JSON in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.guarded import date_or_null

METRICS_LOG_COLUMNS = ["geo", "model", "mae", "mse", "rmse", "notes"]
METRICS_LOG_SCHEMA = "geo string, model string, mae double, mse double, rmse double, notes string"


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "errorifexists").option("header", True).csv(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append metric rows under a fixed header; missing columns stay empty."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in METRICS_LOG_COLUMNS]
    write_csv(df.select(*cols), path, append=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_forecast_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(ds, yhat) files as year and a named prediction column."""
    raw = read_csv(spark, path, "ds string, yhat double")
    return raw.select(F.year(date_or_null(F.substring("ds", 1, 10))).alias("year"), F.col("yhat").alias(name))


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)
