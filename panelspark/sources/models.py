"""Coefficient tables, one folder per model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes

MODEL_COLUMNS = ["features", "coef", "intercept"]


OPTIONAL_COLUMNS = {
    "use_delta": "boolean",
    "rename_map": "map<string,string>",
    "run_id": "string",
    "t0": "double",
    "t_span": "double",
    "bends": "array<struct<at:double,slope:double>>",
    "bend_count": "int",
    "bend_scale": "double",
    "residual_std": "double",
    "trees": "array<struct<feature:array<int>,threshold:array<double>,leaf:array<double>>>",
}


def save_models(coefs: DataFrame, path: str, entity: str) -> None:
    """Append coefficients; all families share one layout, unused parts stay empty."""
    absent = {c: F.lit(None).cast(kind) for c, kind in OPTIONAL_COLUMNS.items() if c not in coefs.columns}
    full = coefs.withColumns(absent).select(entity, "model", *MODEL_COLUMNS, *OPTIONAL_COLUMNS)
    full.write.mode("append").partitionBy("model").parquet(path)


def load_models(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    """Stored coefficients; a choice of models reads only their folders."""
    stored = spark.read.parquet(path)
    return stored.filter(F.col("model").isin(models)) if models else stored


def artifact_keys(files: DataFrame) -> DataFrame:
    """Model and area from artifact names; the folder names the model if the file does not."""
    stem, family = F.col("stem"), F.col("family")
    return files.select(
        "stem", "family", codes.artifact_model(stem, family).alias("model"), codes.artifact_area(stem).alias("geo_code")
    )
