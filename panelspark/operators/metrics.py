"""Forecast errors, each set in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_FOLDS = -1


def r_squared(actual: Column, predicted: Column) -> Column:
    """NULL below two rows; 1 or 0 when the actual values do not vary."""
    squared = F.sum(F.pow(predicted - actual, F.lit(2)))
    spread = F.var_pop(actual) * F.count(actual)
    return (
        F.when(F.count(actual) < 2, F.lit(None).cast("double"))
        .when(spread > 0, 1.0 - squared / F.nullif(spread, F.lit(0.0)))
        .otherwise(F.when(squared == 0, 1.0).otherwise(0.0))
    )


def _errors(df: DataFrame, actual: str, predicted: str):
    return df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()), F.col(predicted) - F.col(actual)


def forecast_metrics(df: DataFrame, by: list[str], actual: str = "actual", predicted: str = "yhat") -> DataFrame:
    """Errors where an actual is known. The percentage divides by the signed actual."""
    known, error = _errors(df, actual, predicted)
    share = F.abs(error) / F.nullif(F.col(actual), F.lit(0.0))
    return known.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r_squared(F.col(actual), F.col(predicted)).alias("r2"),
        (F.avg(share) * 100.0).alias("mape"),
    )


def regression_metrics(df: DataFrame, by: list[str], actual: str = "actual", predicted: str = "yhat") -> DataFrame:
    """Errors with the mean square, and the percentage of the absolute actual."""
    known, error = _errors(df, actual, predicted)
    size = F.when(F.abs(F.col(actual)) >= 1e-12, F.abs(F.col(actual)))
    return known.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r_squared(F.col(actual), F.col(predicted)).alias("r2"),
        (F.avg(F.abs(error) / size) * 100.0).alias("mape"),
    )


def as_metric_rows(wide: DataFrame, by: list[str], scope: str) -> DataFrame:
    """One row per metric, the aggregate over all folds; missing ones left out."""
    names = [c for c in wide.columns if c not in by]
    return (
        wide.unpivot(by, names, "metric", "value")
        .filter(F.col("value").isNotNull())
        .select(*by, "metric", F.lit(scope).alias("scope"), F.lit(ALL_FOLDS).alias("fold"), "value")
    )
