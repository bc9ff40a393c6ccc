"""Train/test splits, rolling-origin backtests, model comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metrics import regression_metrics
from .regression import _stack, _unpack, expanding_predictions, moments, solve_centred


def is_train(period: str, split: int, inclusive: bool = True) -> Column:
    """Trainers keep the split year, the evaluation helpers leave it to the test."""
    return F.col(period) <= split if inclusive else F.col(period) < split


def split_counts(df: DataFrame, entity: str, period: str, split: int) -> DataFrame:
    return df.groupBy(entity).agg(
        F.count_if(is_train(period, split)).alias("train_inclusive"),
        F.count_if(~is_train(period, split)).alias("test_inclusive"),
        F.count_if(is_train(period, split, False)).alias("train_exclusive"),
        F.count_if(~is_train(period, split, False)).alias("test_exclusive"),
    )


def _split_errors(predictions: DataFrame, by: list[str]) -> DataFrame:
    error = F.col("yhat") - F.col("actual")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.count("*").alias("test_rows")
    )


def rolling_backtest(
    df: DataFrame, entity: str, period: str, features: list[str], target: str, first_test: int, *, alpha: float = 0.0
) -> DataFrame:
    """Errors per entity and split period of a linear model refitted before each."""
    predicted = expanding_predictions(df, entity, period, features, target, first_test, alpha=alpha)
    return _split_errors(predicted.withColumnRenamed(period, "split_year"), [entity, "split_year"])


def pooled_backtest(
    df: DataFrame, period: str, features: list[str], target: str, first_test: int, *, alpha: float = 0.0
) -> DataFrame:
    """Errors per split period of one model over all entities.

    Moments are taken per period first. One row per distinct period is
    left; they are merged in period order and solved, and the coefficients go
    back to the test rows.
    """
    complete = df.dropna(subset=[*features, target])
    per_period = moments(complete, [period], features, target)
    width = len(features) + 1
    schema = T.StructType(
        [
            per_period.schema[period],
            T.StructField("coef", T.ArrayType(T.DoubleType())),
            T.StructField("intercept", T.DoubleType()),
        ]
    )

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [batch for batch in batches if not batch.empty]
        if not found:
            return
        rows = pd.concat(found, ignore_index=True).sort_values(period)
        n = rows["n"].to_numpy("float64")
        means, sums = _stack(rows["means"]), _unpack(_stack(rows["sums"]), width)
        out = []
        total, mean, centred = 0.0, np.zeros(width), np.zeros((width, width))
        for i, p in enumerate(rows[period].tolist()):
            if total > 0 and p >= first_test:
                penalty = np.full((1, width - 1), alpha) if alpha > 0 else None
                coef = solve_centred(centred[None, :-1, :-1], centred[None, :-1, -1], penalty)[0]
                out.append((p, coef, mean[-1] - float(coef @ mean[:-1])))
            shift, grown = means[i] - mean, total + n[i]
            centred = centred + sums[i] + np.outer(shift, shift) * (total * n[i] / grown)
            mean, total = mean + shift * (n[i] / grown), grown
        yield pd.DataFrame(out, columns=[period, "coef", "intercept"])

    coefs = per_period.coalesce(1).mapInPandas(merge, schema)
    yhat = F.col("intercept")
    for i, f in enumerate(features):
        yhat = yhat + F.col(f) * F.col("coef")[i]
    tested = complete.join(coefs, period).select(
        F.col(period).alias("split_year"), F.col(target).cast("double").alias("actual"), yhat.alias("yhat")
    )
    return _split_errors(tested, ["split_year"])


def rolling_backtest_with(
    df: DataFrame,
    entity: str,
    period: str,
    features: list[str],
    target: str,
    first_test: int,
    fit: Callable[[np.ndarray, np.ndarray], object],
    predict: Callable[[object, np.ndarray], np.ndarray],
) -> DataFrame:
    """The same with any model given by two functions, refitted per entity and split."""
    rows = df.select(entity, period, *[F.col(c).cast("double").alias(c) for c in [*features, target]])
    schema = T.StructType(
        [
            rows.schema[entity],
            T.StructField("split_year", rows.schema[period].dataType),
            T.StructField("mae", T.DoubleType()),
            T.StructField("rmse", T.DoubleType()),
            T.StructField("test_rows", T.LongType()),
        ]
    )

    def one_entity(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[*features, target]).sort_values(period)
        x, y, when = pdf[features].to_numpy(), pdf[target].to_numpy(), pdf[period].to_numpy()
        out = []
        for split in np.unique(when[when >= first_test]):
            train, test = when < split, when == split
            if not train.any():
                continue
            error = np.asarray(predict(fit(x[train], y[train]), x[test])) - y[test]
            out.append((pdf[entity].iloc[0], split, np.abs(error).mean(), np.sqrt((error**2).mean()), len(error)))
        return pd.DataFrame(out, columns=[f.name for f in schema])

    return rows.groupBy(entity).applyInPandas(one_entity, schema)


def wide_predictions(predictions: DataFrame, entity: str, period: str, models: list[str]) -> DataFrame:
    """One ``yhat_<model>`` column per model."""
    wide = predictions.groupBy(entity, period).pivot("model", models).agg(F.first("yhat", ignorenulls=True))
    return wide.withColumnsRenamed({m: f"yhat_{m}" for m in models})


def evaluate_models(wide: DataFrame, by: list[str], models: list[str], actual: str = "actual") -> DataFrame:
    """Metrics per model from one ``yhat_<model>`` column each."""
    keys = [c for c in wide.columns if not c.startswith("yhat_")]
    long = wide.unpivot(keys, [f"yhat_{m}" for m in models], "model", "yhat")
    long = long.withColumn("model", F.expr("substring(model, 6)"))
    return regression_metrics(long, [*by, "model"], actual)


def residuals(predictions: DataFrame, actual: str = "actual", predicted: str = "yhat") -> DataFrame:
    return predictions.withColumn("residual", F.col(actual) - F.col(predicted))
