"""Serving queries for many areas at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.forecast import COVERED, FUTURE, future_features, predict
from ..operators.panel import densify, fill_mean, fill_neighbours, fill_zero
from ..operators.ranking import top_per_group
from ..operators.registry import best_model
from ..operators.trend import score_trend
from ..session import stored

# ---- Fixed values -------------------------------------------------------------
COMPARED_SURVEYS = ["ACS1_TOTAL_POP", "ACS5_TOTAL_POP"]
COMPARED_FEATURES = {"unemployment_rate": "BLS_UNRATE", "rent_cpi_index": "CPI_SHELTER"}
IMPLIED_CODE = "POPULATION_IMPLIED"
FALLBACK_MODELS = ["ridge", "xgb", "linear"]
# --------------------------------------------------------------------------------


def _window(start: int, end: int, areas: list[str] | None = None) -> Column:
    inside = F.col("year").between(start, end)
    return inside & F.col("geo_code").isin(areas) if areas is not None else inside


def window_slice(matrix: DataFrame, start: int, end: int, areas: list[str] | None = None) -> DataFrame:
    return matrix.filter(_window(start, end, areas)).orderBy("geo_code", "year")


def actuals(population: DataFrame, start: int, end: int, areas: list[str] | None = None) -> DataFrame:
    rows = population.filter(_window(start, end, areas))
    return rows.select("geo_code", "year", F.col("population").cast("double").alias("population")).orderBy("geo_code", "year")


def series(indicators: DataFrame, code_list: list[str], start: int, end: int, areas: list[str] | None = None) -> DataFrame:
    rows = indicators.filter(_window(start, end, areas) & F.col("indicator_code").isin(code_list))
    return rows.select("geo_code", "year", "indicator_code", F.col("value").cast("double").alias("value")).orderBy(
        "geo_code", "year", "indicator_code"
    )


def indicator_slice(indicators: DataFrame, start: int, end: int, areas: list[str] | None = None) -> DataFrame:
    rows = indicators.filter(_window(start, end, areas))
    return rows.select("geo_code", "year", "indicator_code", F.col("value").cast("double").alias("value"), "source", "unit").orderBy(
        "geo_code", "year", "indicator_code"
    )


def areas_of_type(geography: DataFrame, kind: str, matrix: DataFrame | None = None, within: str | None = None) -> DataFrame:
    """Areas of one type, below a prefix, and only those with feature rows if given."""
    rows = geography.filter(F.col("geo_type") == kind)
    if within is not None:
        rows = rows.filter(F.col("geo_code").startswith(within))
    if matrix is not None:
        rows = rows.join(matrix.select("geo_code").distinct(), "geo_code", "left_semi")
    return rows.select("geo_code", "geo_name", "geo_type").orderBy("geo_name", "geo_code")


def attach_actuals(forecasts: DataFrame, population: DataFrame) -> DataFrame:
    """Actual population of the forecast date's year, NULL where none is known."""
    known = population.select("geo_code", "year", F.col("population").cast("double").alias("actual"))
    return forecasts.withColumn("year", F.year("ds")).join(known, ["geo_code", "year"], "left").drop("year")


def predict_trend(matrix: DataFrame, coefs: DataFrame, features: list[str], start: int, end: int) -> DataFrame:
    """Trend models over every year of the range, past the data too.

    Regressors that a year lacks come from the year before, else the next one that
    has them, else the area's mean.
    """
    own = matrix.filter(_window(start, end)).join(coefs.select("geo_code").distinct(), "geo_code", "left_semi")
    dense = densify(own.select("geo_code", "year", *features), "geo_code", "year", start, end)
    filled = fill_zero(fill_mean(fill_neighbours(dense, "geo_code", "year", features), "geo_code", features), features)
    last = own.groupBy("geo_code").agg(F.max("year").alias("last_year"))
    scored = score_trend(filled, coefs, "geo_code", "year", features).join(last, "geo_code")
    return scored.select("geo_code", "year", "yhat", F.when(F.col("year") <= F.col("last_year"), COVERED).otherwise(FUTURE).alias("kind"))


def predict_by_model(
    matrix: DataFrame, coefs: DataFrame, features: list[str], start: int, end: int, history: str = "window"
) -> DataFrame:
    """(geo_code, year, yhat, kind) of one stored model for each area, scored as its family asks for."""
    trend = F.col("model") == codes.TREND_MODEL
    linear = predict(matrix, coefs.filter(~trend), "geo_code", "year", features, start, end, history=history)
    if "t0" not in coefs.columns:
        return linear
    return linear.unionByName(predict_trend(matrix, coefs.filter(trend), features, start, end))


def predictions_vs_actuals(predictions: DataFrame, population: DataFrame, start: int, end: int) -> DataFrame:
    return predictions.select("geo_code", "year", F.col("yhat").alias("predicted")).join(
        actuals(population, start, end).withColumnRenamed("population", "actual"), ["geo_code", "year"], "left"
    )


def choose_model(coefs: DataFrame, wanted: str) -> DataFrame:
    """Coefficients of the wanted model per area, else of the first fallback present."""
    order = [wanted] + [m for m in FALLBACK_MODELS if m != wanted]
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return top_per_group(coefs.filter(F.col("model").isin(order)), ["geo_code"], [rank])


def _long(df: DataFrame, names: dict[str, str], value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("code"), F.col(n).alias(value)) for n, c in names.items()])
    return df.select("geo_code", "year", F.inline(pairs))


def compared_actuals(indicators: DataFrame, matrix: DataFrame, start: int, end: int) -> DataFrame:
    surveys = indicators.filter(_window(start, end) & F.col("indicator_code").isin(COMPARED_SURVEYS)).select(
        "geo_code", "year", F.col("indicator_code").alias("code"), F.col("value").cast("double").alias("actual")
    )
    return surveys.unionByName(_long(matrix.filter(_window(start, end)), COMPARED_FEATURES, "actual"))


def dense_series(df: DataFrame, areas: DataFrame, start: int, end: int, code_list: list[str]) -> DataFrame:
    """Every area, code and year of the range; values are NULL where none exist."""
    keys = areas.select("geo_code").distinct().withColumns(
        {
            "code": F.explode(F.array(*[F.lit(c) for c in code_list])),
        }
    ).withColumn("year", F.explode(F.sequence(F.lit(start), F.lit(end))))
    return keys.join(df, ["geo_code", "code", "year"], "left")


def features_compare(
    indicators: DataFrame, matrix: DataFrame, coefs: DataFrame, features: list[str], start: int, end: int, model: str = "linear"
) -> DataFrame:
    """Actual and projected indicators per area over a dense range of years.

    Rates and prices are projected as in the roll-forward; the implied
    population comes from the chosen model of each area.
    """
    known = compared_actuals(indicators, matrix, start, end)
    past = matrix.filter(_window(start, end))
    future = future_features(past, choose_model(coefs, model), "geo_code", "year", features, end=end)
    projected = _long(future, {**COMPARED_FEATURES, "population_implied": IMPLIED_CODE}, "projected")
    both = known.unionByName(projected, allowMissingColumns=True)
    merged = both.groupBy("geo_code", "code", "year").agg(F.max("actual").alias("actual"), F.max("projected").alias("projected"))
    merged = stored(merged, "merged")  # read for the keys and for the values
    order = [*COMPARED_SURVEYS, *COMPARED_FEATURES.values(), IMPLIED_CODE]
    return dense_series(merged, merged, start, end, order)


def series_long(population: DataFrame, predictions: DataFrame, start: int, end: int) -> DataFrame:
    """Actual values and each model's predictions as labelled series."""
    actual = actuals(population, start, end).select("geo_code", "year", F.lit("actual").alias("label"), F.col("population").alias("value"))
    models = predictions.select("geo_code", "year", F.col("model").alias("label"), F.col("yhat").alias("value"))
    return actual.unionByName(models)


def best_model_series(
    card: DataFrame, coefs: DataFrame, matrix: DataFrame, population: DataFrame, features: list[str], start: int, end: int
) -> DataFrame:
    """Predictions of each area's best model beside the actual values, every year of the range."""
    best = best_model(card)
    chosen = coefs.join(best.select("geo_code", F.col("best_model").alias("model")), ["geo_code", "model"], "left_semi")
    predicted = predict_by_model(matrix, chosen, features, start, end)
    both = predicted.select("geo_code", "year", "yhat").join(
        actuals(population, start, end).withColumnRenamed("population", "actual"), ["geo_code", "year"], "full_outer"
    )
    dense = densify(both, "geo_code", "year", start, end)
    return dense.join(best.select("geo_code", F.col("best_model").alias("label")), "geo_code")
