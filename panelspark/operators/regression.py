"""Linear models per entity.

Centred sums of squares and products come from built-in covariance
aggregates, which combine before the shuffle and stay accurate for large
levels. What is left is one small system per entity; those are solved in Arrow
batches of many entities at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK_TOLERANCE = 1e-11


def _moments(features: list[str], target: str, over=None) -> list[Column]:
    """Row count, means, and upper triangle of centred sums, target last."""
    cols = [*features, target]

    def windowed(c: Column) -> Column:
        return c.over(over) if over is not None else c

    n = windowed(F.count(F.lit(1)))
    means = [windowed(F.avg(c)) for c in cols]
    sums = [windowed(F.covar_pop(a, b)) * n for i, a in enumerate(cols) for b in cols[i:]]
    return [n.alias("n"), F.array(*means).alias("means"), F.array(*sums).alias("sums")]


def moments(df: DataFrame, by: list[str], features: list[str], target: str) -> DataFrame:
    """Sufficient statistics of complete rows per group."""
    return df.dropna(subset=[*features, target]).groupBy(*by).agg(*_moments(features, target))


def _unpack(sums: np.ndarray, width: int) -> np.ndarray:
    full = np.zeros((len(sums), width, width))
    upper = np.triu_indices(width)
    full[:, upper[0], upper[1]] = sums
    full[:, upper[1], upper[0]] = sums
    return full


def solve_centred(gram: np.ndarray, cross: np.ndarray, penalty: np.ndarray | None = None) -> np.ndarray:
    """Coefficients of many centred systems; smallest norm where not unique."""
    size = gram.shape[1]
    if penalty is not None:
        gram = gram + penalty[:, :, None] * np.eye(size)
    scale = np.sqrt(np.einsum("nii->ni", gram))
    scale[~(scale > 0)] = 1.0
    values, vectors = np.linalg.eigh(gram / scale[:, :, None] / scale[:, None, :])
    kept = values > RANK_TOLERANCE * np.maximum(values.max(axis=1, keepdims=True), 1e-300)
    inverse = np.where(kept, 1.0 / np.where(kept, values, 1.0), 0.0)
    rotated = np.einsum("nij,ni->nj", vectors, cross / scale)
    solution = np.einsum("nij,nj->ni", vectors, inverse * rotated) / scale
    free = ~kept.all(axis=1)
    if free.any():
        null = vectors[free] * ~kept[free][:, None, :] / scale[free][:, :, None]
        null /= np.maximum(np.linalg.norm(null, axis=1, keepdims=True), 1e-300)
        part = np.einsum("nij,nj->ni", np.linalg.pinv(null), solution[free])
        solution[free] -= np.einsum("nij,nj->ni", null, part)
    return solution


def _stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype="float64")


def fit_linear(
    df: DataFrame, entity: str, features: list[str], target: str, *, alpha: float = 0.0, model: str | None = None
) -> DataFrame:
    """Least squares with intercept per entity; ``alpha`` > 0 adds a ridge penalty
    on the unscaled coefficients but not on the intercept."""
    name = model or ("ridge" if alpha > 0 else "linear")
    stats = moments(df, [entity], features, target)
    schema = T.StructType(
        [
            stats.schema[entity],
            T.StructField("coef", T.ArrayType(T.DoubleType())),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("train_rows", T.LongType()),
        ]
    )
    width = len(features) + 1

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            full, means = _unpack(_stack(batch["sums"]), width), _stack(batch["means"])
            gram, cross = full[:, :-1, :-1], full[:, :-1, -1]
            penalty = np.full(cross.shape, alpha) if alpha > 0 else None
            coef = solve_centred(gram, cross, penalty)
            intercept = means[:, -1] - np.einsum("ni,ni->n", coef, means[:, :-1])
            yield pd.DataFrame(
                {entity: batch[entity], "coef": list(coef), "intercept": intercept, "train_rows": batch["n"]}
            )

    return stats.mapInPandas(solve, schema).select(
        entity,
        F.lit(name).alias("model"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        "coef",
        "intercept",
        F.lit(False).alias("use_delta"),
        "train_rows",
    )


def linear_score(features: list[str], coef: str = "coef", intercept: str = "intercept") -> Column:
    """Prediction from columns and a coefficient array, inside generated code."""
    score = F.col(intercept)
    for i, f in enumerate(features):
        score = score + F.col(f) * F.col(coef)[i]
    return score


def expanding_predictions(
    df: DataFrame, entity: str, period: str, features: list[str], target: str, first_test: int, *, alpha: float = 0.0
) -> DataFrame:
    """Predict each row from ``first_test`` on by a model of the entity's earlier rows.

    Running moments over one window replace a refit loop: every row carries the
    statistics of the rows before it.
    """
    from .panel import by_entity
    from pyspark.sql import Window as W

    earlier = by_entity(entity, period).rowsBetween(W.unboundedPreceding, -1)
    complete = df.dropna(subset=[*features, target])
    rows = complete.select(
        entity,
        period,
        F.col(target).cast("double").alias("actual"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
        *_moments(features, target, earlier),
    ).filter((F.col(period) >= first_test) & (F.col("n") > 0))
    schema = T.StructType(
        [
            rows.schema[entity],
            rows.schema[period],
            T.StructField("actual", T.DoubleType()),
            T.StructField("yhat", T.DoubleType()),
            T.StructField("train_rows", T.LongType()),
        ]
    )
    width = len(features) + 1

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            full, means, x = _unpack(_stack(batch["sums"]), width), _stack(batch["means"]), _stack(batch["x"])
            cross = full[:, :-1, -1]
            penalty = np.full(cross.shape, alpha) if alpha > 0 else None
            coef = solve_centred(full[:, :-1, :-1], cross, penalty)
            yhat = means[:, -1] + np.einsum("ni,ni->n", coef, x - means[:, :-1])
            yield pd.DataFrame(
                {
                    entity: batch[entity],
                    period: batch[period],
                    "actual": batch["actual"],
                    "yhat": yhat,
                    "train_rows": batch["n"],
                }
            )

    return rows.mapInPandas(predict, schema)
