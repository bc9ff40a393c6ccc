"""JSON columns kept as Variant: parsed once, stored in binary form, read by path and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(df: DataFrame, *cols: str) -> DataFrame:
    """The named text columns as Variant.

    Text that is not JSON becomes null, with its column's name in ``malformed``; null
    text is no fault. A JSON null is a Variant that holds null.
    """
    values = {c: F.try_parse_json(F.col(c)) for c in cols}
    faults = [F.when(F.col(c).isNotNull() & values[c].isNull(), F.lit(c)) for c in cols]
    return df.select("*", F.array_compact(F.array(*faults)).alias("malformed")).withColumns(values)


def field(col: str, path: str, kind: str) -> Column:
    """The value at a path as a type; null if the path is absent or the value does not fit."""
    return F.try_variant_get(F.col(col), path, kind)


def fields(df: DataFrame, col: str, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """A column for each name, from its (path, type); the text is not parsed again for any of them."""
    return df.withColumns({name: field(col, path, kind) for name, (path, kind) in wanted.items()})


def shapes(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """The common schema of each group's documents and their number; partial schemas merge before the shuffle."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(F.col(col)).alias("shape"), F.count(col).alias("documents"))


def texts(df: DataFrame, *cols: str) -> DataFrame:
    """Variant columns as JSON text, for sinks that know no Variant."""
    return df.withColumns({c: F.to_json(F.col(c)) for c in cols})
