"""Scoring known periods and rolling forecasts forward."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.guarded import clamp
from .regression import linear_score
from .trees import TREES, evaluate, tree_score

# ---- Fixed values: roll-forward settings ------------------------------------
LOOKBACK = 5
MODEL_WEIGHT = 0.70
CLAMP_DEVIATIONS = 2.0
SOFT_CLAMP = 0.05
RATE_TARGET = 4.5
RATE_DECAY = 0.50
RATE_MIN, RATE_MAX = 2.0, 15.0
INDEX_GROWTH_TARGET = 0.025
INDEX_WEIGHT = 0.60
# ------------------------------------------------------------------------------

COVERED, FUTURE = "covered", "future"


def aligned(coefs: DataFrame, features: list[str]) -> DataFrame:
    """Models made ready for columns in the order of ``features``, found by the names stored with them.

    Coefficients are put in that order; trees keep theirs, and ``inputs`` says where each
    of their features is. A stored ``rename_map`` gives the model's name of a column.
    Missing features, or coefficients of another number, are an error when the row is used.
    """
    names = [F.lit(f) for f in features]
    trees = F.col("trees") if "trees" in coefs.columns else F.lit(None).cast(TREES)
    fits = F.size("coef") == len(features)
    coef, inputs = F.col("coef"), F.lit(None).cast("array<int>")
    if "features" in coefs.columns:
        if "rename_map" in coefs.columns:
            names = [F.coalesce(F.try_element_at("rename_map", n), n) for n in names]
        fits = (fits | trees.isNotNull()) & (F.size("features") == len(features)) & (F.size(F.array_except(F.array(*names), "features")) == 0)
        places = F.transform(F.array(*names), lambda n: F.array_position("features", n).cast("int"))
        coef = F.transform(places, lambda i: F.get("coef", i - 1))
        inputs = F.transform("features", lambda n: (F.array_position(F.array(*names), n) - 1).cast("int"))
    error = F.raise_error(F.lit(f"the stored model does not have the features {features}"))
    return coefs.withColumns(
        {
            "trees": trees,
            "coef": F.when(fits, F.when(trees.isNull(), coef)).otherwise(error.cast("array<double>")),
            "inputs": F.when(trees.isNotNull(), inputs),
        }
    )


MODEL_PARTS = ["coef", "intercept", "use_delta", "trees", "inputs"]


def predict_known(matrix: DataFrame, coefs: DataFrame, entity: str, period: str, features: list[str]) -> DataFrame:
    """Score the periods that exist, by coefficients or trees: gaps count as zero, delta models get the lag added."""
    scored = (
        matrix.select(entity, period, *features)
        .fillna(0.0, subset=features)
        .join(aligned(coefs, features).select(entity, *MODEL_PARTS), entity)
    )
    lag = F.coalesce(F.col("pop_lag1"), F.lit(0.0)) if "pop_lag1" in features else F.lit(0.0)
    raw = linear_score(features)
    if "trees" in coefs.columns:
        values = F.array(*[F.col(f).cast("double") for f in features])
        raw = F.when(F.col("trees").isNull(), raw).otherwise(tree_score(F.transform("inputs", lambda i: F.get(values, i))))
    return scored.select(entity, period, F.when(F.col("use_delta"), raw + lag).otherwise(raw).alias("yhat"))


def naive_future(matrix: DataFrame, coefs: DataFrame, entity: str, period: str, features: list[str], horizon: int) -> DataFrame:
    """Carry the last feature row of each entity for ``horizon`` periods and score it."""
    last = matrix.groupBy(entity).agg(
        F.max(period).alias("_last"), *[F.max_by(f, period).alias(f) for f in features]
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    rows = last.withColumn("_step", steps).withColumn(period, (F.col("_last") + F.col("_step")).cast(matrix.schema[period].dataType))
    return predict_known(rows, coefs, entity, period, features)


def backcast_and_naive_future(
    matrix: DataFrame, coefs: DataFrame, entity: str, period: str, features: list[str], horizon: int
) -> DataFrame:
    known = predict_known(matrix, coefs, entity, period, features)
    if horizon <= 0:
        return known
    return known.unionByName(naive_future(matrix, coefs, entity, period, features, horizon))


def project_rate(start: DataFrame, entity: str, last_period: str, rate: str, horizon: int, period: str) -> DataFrame:
    """Mean-reverting projection of a rate, clipped each step."""
    path = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.array(F.coalesce(F.col(rate), F.lit(RATE_TARGET))),
        lambda acc, _: F.concat(
            acc,
            F.array(
                clamp(
                    F.lit(RATE_TARGET) + (F.element_at(acc, -1) - RATE_TARGET) * (1.0 - RATE_DECAY), RATE_MIN, RATE_MAX
                )
            ),
        ),
    )
    return start.select(entity, F.col(last_period).alias("_last"), F.posexplode(path).alias("_step", rate)).filter(
        F.col("_step") > 0
    ).select(entity, (F.col("_last") + F.col("_step")).alias(period), rate)


def project_index(start: DataFrame, entity: str, last_period: str, index: str, growth: str, horizon: int, period: str) -> DataFrame:
    """Index growing by a blend of its recent growth rate and the target, held constant."""
    blend = F.col(growth) * INDEX_WEIGHT + F.lit((1.0 - INDEX_WEIGHT) * INDEX_GROWTH_TARGET)
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    grown = F.when(F.col(index) > 0, F.col(index) * F.pow(1.0 + blend, F.col("_step"))).otherwise(F.col(index))
    return start.withColumn("_step", step).select(
        entity, (F.col(last_period) + F.col("_step")).alias(period), grown.alias(index)
    )


def history_state(history: DataFrame, entity: str, period: str, others: list[str]) -> DataFrame:
    """What a forecast needs of an entity's past, in one shuffle and one row each.

    The history has one row per entity and period, so the lists are bounded by
    the calendar before they are cut to the newest ``LOOKBACK + 1`` known values.
    """

    def tail(col: str):
        pair = F.struct(F.col(period).cast("long").alias("p"), F.col(col).cast("double").alias("v"))
        known = F.sort_array(F.collect_list(F.when(F.col(col).isNotNull(), pair)), asc=False)
        return F.reverse(F.slice(known, 1, LOOKBACK + 1))

    def last(col: str):
        return F.max_by(F.col(col).cast("double"), F.when(F.col(col).isNotNull(), F.col(period)))

    return history.groupBy(entity).agg(
        F.max(period).cast("long").alias("last_period"),
        tail("population").alias("levels"),
        tail("rent_cpi_index").alias("indexes"),
        last("unemployment_rate").alias("last_rate"),
        *[last(c).alias(f"last_{c}") for c in others],
    )


def _tail_matrix(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Right-aligned values and periods of the last known pairs, NaN where absent."""
    width = LOOKBACK + 1
    values, periods = np.full((len(column), width), np.nan), np.full((len(column), width), np.nan)
    for i, pairs in enumerate(column):
        if pairs is None:
            continue
        for j, pair in enumerate(reversed(list(pairs))):
            periods[i, width - 1 - j], values[i, width - 1 - j] = pair["p"], pair["v"]
    return values, periods


def _oldest(tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First known value of each row and the number of steps to the last one."""
    known = ~np.isnan(tail)
    count = known.sum(axis=1)
    first = tail[np.arange(len(tail)), np.argmax(known, axis=1)]
    return first, count - 1


def _growth(tail: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    first, steps = _oldest(tail)
    with np.errstate(all="ignore"):
        rate = np.power(tail[:, -1] / first, 1.0 / np.maximum(steps, 1)) - 1.0
    return np.where((steps > 0) & (first > 0), rate, otherwise)


def _difference_stats(tail: np.ndarray, mean: np.ndarray, std: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.diff(tail, axis=1)
    count = (~np.isnan(steps)).sum(axis=1)
    filled = np.where(np.isnan(steps), 0.0, steps)
    divisor = np.maximum(count, 1)
    new_mean = filled.sum(axis=1) / divisor
    spread = np.where(np.isnan(steps), 0.0, steps - new_mean[:, None])
    new_std = np.sqrt((spread**2).sum(axis=1) / divisor)
    return np.where(count > 0, new_mean, mean), np.where(count > 0, new_std, std)


def _append(tail: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Push known values to the right end; rows whose value is unknown stay."""
    moved = np.concatenate([tail[:, 1:], values[:, None]], axis=1)
    return np.where(np.isnan(values)[:, None], tail, moved)


def _scorer(batch: pd.DataFrame, features: list[str]) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    """From the values of each feature to the predictions of a batch's models, coefficients and trees alike."""
    size, intercept = len(batch), batch["intercept"].to_numpy("float64")
    coef = np.array([c if c is not None else [0.0] * len(features) for c in batch["coef"]], dtype="float64").reshape(size, len(features))
    grown = np.flatnonzero(batch["trees"].notna().to_numpy())
    groups: dict[tuple[int, int], list[int]] = {}
    for i in grown.tolist():  # models with as many trees and nodes go together
        trees = batch["trees"].iloc[i]
        groups.setdefault((len(trees), len(trees[0]["feature"]) if len(trees) else 0), []).append(i)
    packed = []
    for (count, _), at in groups.items():
        if count:
            own = [batch["trees"].iloc[i] for i in at]
            parts = [np.array([[t[name] for t in trees] for trees in own]) for name in ("feature", "threshold", "leaf")]
            packed.append((np.array(at), np.array(batch["inputs"].iloc[at].tolist(), dtype="int64"), parts))

    def score(known: dict[str, np.ndarray]) -> np.ndarray:
        out = intercept + sum(coef[:, i] * known[f] for i, f in enumerate(features))
        for at, inputs, parts in packed:
            x = np.stack([known[f][at] for f in features], axis=1)
            out[at] = evaluate(np.take_along_axis(x, inputs, axis=1), intercept[at], *parts)
        return out

    return score


def _roll_batch(batch: pd.DataFrame, entity: str, period: str, features: list[str], others: list[str], end: int | None, horizon: int | None) -> pd.DataFrame:
    size, width = len(batch), LOOKBACK + 1
    last_period = batch["last_period"].to_numpy("int64")
    until = np.full(size, end, dtype="int64") if end is not None else last_period + horizon
    longest = int(max((until - last_period).max(), 0))
    score = _scorer(batch, features)
    delta = batch["use_delta"].to_numpy("bool")

    levels, level_periods = _tail_matrix(batch["levels"])
    indexes, _ = _tail_matrix(batch["indexes"])
    rate = batch["last_rate"].fillna(RATE_TARGET).to_numpy("float64")
    constant = {c: batch[f"last_{c}"].fillna(0.0).to_numpy("float64") for c in others}

    # Values by period: column k holds last_period - LOOKBACK + k, so lags are found by value.
    by_period = np.full((size, width + longest), np.nan)
    rows, cols = np.nonzero(~np.isnan(level_periods))
    slot = (level_periods[rows, cols] - last_period[rows]).astype("int64") + LOOKBACK
    inside = (slot >= 0) & (slot < width)
    by_period[rows[inside], slot[inside]] = levels[rows[inside], cols[inside]]

    zero = np.zeros(size)
    growth = _growth(levels, zero)
    step_mean, step_std = _difference_stats(levels, zero, zero)
    index_growth = _growth(indexes, np.full(size, INDEX_GROWTH_TARGET))

    parts = []
    for k in range(longest):
        rate = np.clip(RATE_TARGET + (rate - RATE_TARGET) * (1.0 - RATE_DECAY), RATE_MIN, RATE_MAX)
        index = np.where(np.isnan(indexes[:, -1]), 0.0, indexes[:, -1])
        step = INDEX_WEIGHT * index_growth + (1.0 - INDEX_WEIGHT) * INDEX_GROWTH_TARGET
        index = np.where(index > 0, index * (1.0 + step), index)

        lag5, lag2, lag1 = by_period[:, k + 1], by_period[:, k + width - 2], by_period[:, k + width - 1]
        near = np.stack([lag2, lag1], axis=1)
        seen = (~np.isnan(near)).sum(axis=1)
        latest = np.where(np.isnan(levels[:, -1]), 0.0, levels[:, -1])
        mean_near = np.where(seen > 0, np.nansum(near, axis=1) / np.maximum(seen, 1), latest)
        known = {
            "unemployment_rate": rate,
            "rent_cpi_index": index,
            "pop_lag1": np.nan_to_num(lag1, nan=0.0),
            "pop_lag5": np.nan_to_num(lag5, nan=0.0),
            "pop_ma3": mean_near,
            "pop_yoy_growth_pct": zero,
            "pop_cagr_5yr_pct": zero,
            period: (last_period + k + 1).astype("float64"),
            **constant,
        }
        raw = score(known)
        level = np.where(delta, raw + known["pop_lag1"], raw)

        anchored = ~np.isnan(lag1) & (lag1 > 0)
        base = np.where(anchored, lag1, 1.0)
        blend = MODEL_WEIGHT * level + (1.0 - MODEL_WEIGHT) * base * (1.0 + growth)
        band = CLAMP_DEVIATIONS * step_std
        banded = base + np.clip(blend - base, step_mean - band, step_mean + band)
        softly = np.clip(blend, base * (1.0 - SOFT_CLAMP), base * (1.0 + SOFT_CLAMP))
        yhat = np.where(anchored, np.where(step_std > 0, banded, softly), level)

        out = {entity: batch[entity].to_numpy(), period: last_period + k + 1, "yhat": yhat}
        out.update({c: known[c] for c in ["unemployment_rate", "rent_cpi_index", "pop_lag1", "pop_lag5", "pop_ma3"]})
        part = pd.DataFrame(out)
        parts.append(part[last_period + k + 1 <= until])

        by_period[:, k + width] = yhat
        levels, indexes = _append(levels, yhat), _append(indexes, index)
        growth = _growth(levels, growth)
        step_mean, step_std = _difference_stats(levels, step_mean, step_std)
        index_growth = _growth(indexes, index_growth)
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


def roll_forward(
    history: DataFrame,
    coefs: DataFrame,
    entity: str,
    period: str,
    features: list[str],
    *,
    end: int | None = None,
    horizon: int | None = None,
) -> DataFrame:
    """Forecast each entity period by period from its own predictions.

    Rates and indexes are projected, the model's level is blended with the recent
    growth trend, and steps outside the recent band are clamped. Each entity's
    past is first cut to a few values, so one Arrow batch advances thousands of
    entities together, one array operation per period.
    """
    if (end is None) == (horizon is None):
        raise ValueError("give either the last period or a horizon")
    handled = {"unemployment_rate", "rent_cpi_index", "pop_lag1", "pop_lag5", "pop_ma3", "pop_yoy_growth_pct", "pop_cagr_5yr_pct", period}
    others = [f for f in features if f not in handled]
    state = history_state(history, entity, period, others).join(
        aligned(coefs, features).select(entity, *MODEL_PARTS), entity
    )
    schema = T.StructType(
        [state.schema[entity], T.StructField(period, T.LongType())]
        + [
            T.StructField(c, T.DoubleType())
            for c in ["yhat", "unemployment_rate", "rent_cpi_index", "pop_lag1", "pop_lag5", "pop_ma3"]
        ]
    )

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.empty:
                rolled = _roll_batch(batch, entity, period, features, others, end, horizon)
                if not rolled.empty:
                    yield rolled

    rolled = state.mapInPandas(advance, schema)
    return rolled.withColumn(period, F.col(period).cast(history.schema[period].dataType))


def future_features(history: DataFrame, coefs: DataFrame, entity: str, period: str, features: list[str], **until) -> DataFrame:
    """The generated feature rows of future periods with the implied population."""
    rolled = roll_forward(history, coefs, entity, period, features, **until)
    shown = [f for f in features if f in rolled.columns and f != period]
    return rolled.select(entity, period, *shown, F.col("yhat").alias("population_implied"))


def predict(
    matrix: DataFrame, coefs: DataFrame, entity: str, period: str, features: list[str], start: int, end: int, history: str = "full"
) -> DataFrame:
    """Known periods of [start, end] scored, later ones rolled forward up to ``end``.

    With ``history='window'`` the roll-forward sees only the requested periods.
    """
    window = matrix.filter(F.col(period).between(start, end))
    known = predict_known(window, coefs, entity, period, features).withColumn("kind", F.lit(COVERED))
    past = window if history == "window" else matrix.filter(F.col(period) <= end)
    future = roll_forward(past, coefs, entity, period, features, end=end).select(entity, period, "yhat", F.lit(FUTURE).alias("kind"))
    return known.unionByName(future.filter(F.col(period) >= start))
