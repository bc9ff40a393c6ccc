"""Export of everything known about a range of years as CSV folders."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.forecast import future_features
from ..sources.files import write_csv
from .serve import indicator_slice, predict_by_model, predictions_vs_actuals, window_slice

STATUS_SCHEMA = "dataset string, model string, status string, detail string"


def export_bundle(
    root: str,
    indicators: DataFrame,
    matrix: DataFrame,
    population: DataFrame,
    coefs: DataFrame,
    features: list[str],
    start: int,
    end: int,
    *,
    model: str = "all",
    include_future: bool = True,
    areas: list[str] | None = None,
) -> DataFrame:
    """Write one folder per dataset and return their status.

    A model that cannot be exported yields an error row; the others go on.
    """
    if start > end:
        raise ValueError("start must not be after end")
    spark: SparkSession = matrix.sparkSession
    status: list[tuple[str, str | None, str, str | None]] = []

    def write(dataset: str, name: str | None, df: DataFrame) -> None:
        path = f"{root}/{dataset}" + (f"/model={name}" if name else "")
        try:
            write_csv(df, path)
            status.append((dataset, name, "written", path))
        except PySparkException as error:
            status.append((dataset, name, "error", error.getCondition()))

    write("indicators", None, indicator_slice(indicators, start, end, areas))
    window = window_slice(matrix, start, end, areas)
    write("feature_matrix", None, window)
    wanted = codes.MODEL_NAMES if model.lower() == "all" else [model.lower()]
    known = coefs.filter(F.col("model").isin(codes.MODEL_NAMES)).select("model").distinct()
    stored = {row["model"] for row in known.collect()}  # at most the model names
    for name in wanted:
        if name not in stored:
            status.append(("predictions", name, "error", "no trained model"))
            continue
        own = coefs.filter(F.col("model") == name)
        predicted = predict_by_model(window, own, features, start, end)
        write("predictions", name, predictions_vs_actuals(predicted, population, start, end))
        if include_future and name != codes.TREND_MODEL:  # a trend makes no feature rows
            write("future_features", name, future_features(window, own, "geo_code", "year", features, end=end))
    return spark.createDataFrame(status, STATUS_SCHEMA)
