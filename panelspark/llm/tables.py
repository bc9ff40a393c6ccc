"""Registered queries of this folder and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of (spark, folder), with the SQL that gives the same rows if there is one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own, and its column's name; stored, so that numbers stay as they are.

    Operators that answer by id can then answer by row, whatever ids are null or repeated.
    """
    name = "row_number"
    while name in df.columns:
        name += "_"
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered"), name
