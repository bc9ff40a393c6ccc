"""Model fitting, backtests and forecasts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import backtest as bt
from ..operators import forecast as fc
from ..operators import panel as p
from ..operators.boosted import fit_boosted, score_boosted
from ..operators.regression import fit_linear
from ..operators.trend import fit_trend, score_trend
from ..plans.features import REGRESSORS
from ..plans.training import train_all as run_training, train_family
from ..session import checkpointed
from .base import query, r, rounded
from .model_sql import fit_sql, moments_sql, one_bend_sql, roll_sql, score_sql, solve_sql

SPLIT = 24000  # December 1999
FIRST_TEST = 24001
HORIZON = 10
TRAIN_SQL = f"mtrain AS (SELECT * FROM mfeat WHERE period <= {SPLIT})"
BOOST_ROUNDS = 5


def _features(spark, d):
    return b.month_features(spark, d)


def _train(spark, d):
    return _features(spark, d).filter(bt.is_train("period", SPLIT))


def _coef_columns(coefs, count):
    digits = [6, 6, 0, 1] if count > 1 else [6]
    cols = [F.round(F.col("coef")[i], digits[i]).alias(f"c{i + 1}") for i in range(count)]
    return coefs.select("entity", *cols, F.round("intercept", 0).alias("intercept"), "train_rows")


def _coef_sql(count):
    digits = [6, 6, 0, 1] if count > 1 else [6]
    cols = ", ".join(r(f"x_{i + 1}", digits[i], f"c{i + 1}") for i in range(count))
    return f"SELECT entity, {cols}, {r('x0', 0, 'intercept')}, n AS train_rows FROM fit WHERE n >= 8"


def _enough(coefs):
    return coefs.filter(F.col("train_rows") >= 8)


@query(
    "ols_1f",
    f"""SELECT entity, {r('regr_slope(population, pop_lag1)', 6, 'c1')}, {r('regr_intercept(population, pop_lag1)', 0, 'intercept')},
          count(*) AS train_rows FROM mtrain GROUP BY 1 HAVING count(*) >= 8""",
    ",\n" + TRAIN_SQL,
)
def ols_1f(spark, d):
    return _coef_columns(_enough(fit_linear(_train(spark, d), "entity", ["pop_lag1"], "population")), 1)


@query("ols_2f", _coef_sql(2), ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", REGRESSORS[:2]))
def ols_2f(spark, d):
    return _coef_columns(_enough(fit_linear(_train(spark, d), "entity", REGRESSORS[:2], "population")), 2)


@query("ols_nf", _coef_sql(4), ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", REGRESSORS))
def ols_nf(spark, d):
    return _coef_columns(_enough(fit_linear(_train(spark, d), "entity", REGRESSORS, "population")), 4)


@query("ridge_1f", _coef_sql(1), ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", ["unemployment_rate"], alpha=1.0))
def ridge_1f(spark, d):
    return _coef_columns(_enough(fit_linear(_train(spark, d), "entity", ["unemployment_rate"], "population", alpha=1.0)), 1)


@query("ridge_nf", _coef_sql(4), ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", REGRESSORS, alpha=1.0))
def ridge_nf(spark, d):
    return _coef_columns(_enough(fit_linear(_train(spark, d), "entity", REGRESSORS, "population", alpha=1.0)), 4)


@query("boosted_pooled")
def boosted_pooled(spark, d):
    rows = checkpointed(_features(spark, d))
    trees = fit_boosted(rows.filter(bt.is_train("period", SPLIT)), REGRESSORS, rounds=BOOST_ROUNDS)
    return score_boosted(rows, trees, REGRESSORS).select("entity", "period", "population", "yhat")


@query("trend_changepoint")
def trend_changepoint(spark, d):
    coefs = fit_trend(_train(spark, d), "entity", "period", "population", REGRESSORS)
    scored = score_trend(_features(spark, d), coefs, "entity", "period", REGRESSORS)
    return scored.select("entity", "period", "population", "yhat", "yhat_lo", "yhat_hi")


@query("predict_trend")
def predict_trend(spark, d):
    """Trend forecast over a dense range, regressors filled from their neighbours."""
    rows = _features(spark, d)
    coefs = fit_trend(rows.filter(bt.is_train("period", SPLIT)), "entity", "period", "population", REGRESSORS)
    means = rows.groupBy("entity", "period").agg(*[F.avg(c).alias(c) for c in REGRESSORS])
    dense = p.densify(means, "entity", "period", SPLIT + 1, SPLIT + 24)
    filled = p.fill_mean(p.fill_neighbours(dense, "entity", "period", REGRESSORS), "entity", REGRESSORS)
    return score_trend(filled, coefs, "entity", "period", REGRESSORS).select("entity", "period", "yhat", "yhat_lo", "yhat_hi")


@query(
    "trend_one_bend",
    f"SELECT entity, period, {r('yhat', -1, 'yhat')}, {r('yhat_lo', -1, 'yhat_lo')}, {r('yhat_hi', -1, 'yhat_hi')} FROM bent",
    ",\n" + TRAIN_SQL + ",\n" + one_bend_sql("bent", "mtrain", SPLIT - 11, SPLIT + 24),
)
def trend_one_bend(spark, d):
    """Trend with one possible change of slope: a year of the past, two ahead with simulated intervals."""
    train = _train(spark, d)
    coefs = fit_trend(train, "entity", "period", "population", [], changepoints=1)
    months = F.explode(F.sequence(F.lit(SPLIT - 11), F.lit(SPLIT + 24))).alias("period")
    scored = score_trend(train.select("entity").distinct().select("entity", months), coefs, "entity", "period", [])
    return rounded(scored, yhat=-1, yhat_lo=-1, yhat_hi=-1)


FIT_SQL = ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", REGRESSORS, alpha=1.0)


def _ridge(spark, d):
    return fit_linear(_train(spark, d), "entity", REGRESSORS, "population", alpha=1.0)


@query("predict_in_coverage", f"SELECT entity, period, {r(score_sql(REGRESSORS), 0, 'yhat')} FROM mfeat JOIN fit USING (entity)", FIT_SQL)
def predict_in_coverage(spark, d):
    return rounded(fc.predict_known(_features(spark, d), _ridge(spark, d), "entity", "period", REGRESSORS), yhat=0)


@query(
    "backcast_and_naive_future",
    f"""SELECT entity, period, {r(score_sql(REGRESSORS), 0, 'yhat')} FROM (
          SELECT entity, period, {', '.join(REGRESSORS)} FROM mfeat
          UNION ALL
          SELECT entity, CAST(period + k AS INTEGER), {', '.join(REGRESSORS)}
          FROM (SELECT * FROM mfeat QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) = 1),
               (SELECT unnest(range(1, {HORIZON + 1})) AS k) s) JOIN fit USING (entity)""",
    FIT_SQL,
)
def backcast_and_naive_future(spark, d):
    rows = fc.backcast_and_naive_future(_features(spark, d), _ridge(spark, d), "entity", "period", REGRESSORS, HORIZON)
    return rounded(rows, yhat=0)


@query(
    "split_counts",
    f"""SELECT entity, count(*) FILTER (WHERE period <= {SPLIT}) AS train_inclusive, count(*) FILTER (WHERE period > {SPLIT}) AS test_inclusive,
          count(*) FILTER (WHERE period < {SPLIT}) AS train_exclusive, count(*) FILTER (WHERE period >= {SPLIT}) AS test_exclusive
        FROM mpanel GROUP BY 1""",
)
def split_counts(spark, d):
    return bt.split_counts(b.month_panel(spark, d), "entity", "period", SPLIT)


BEFORE = " OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
BACKTEST_SQL = f"""SELECT entity, period AS split_year, {r('abs(e)', 0, 'mae')}, {r('abs(e)', 0, 'rmse')}, CAST(1 AS BIGINT) AS test_rows
  FROM (SELECT entity, period, my + x_1 * (pop_lag1 - m_1) - population AS e FROM run)"""
BACKTEST_CTE = (
    ",\nrun_m AS (SELECT entity, period, population, pop_lag1, "
    + moments_sql(["pop_lag1"], "population", BEFORE)
    + " FROM mfeat),\n"
    + f"run_t AS (SELECT * FROM run_m WHERE period >= {FIRST_TEST} AND n > 0),\n"
    + solve_sql("run", "run_t", 1)
)


@query("rolling_backtest", BACKTEST_SQL, BACKTEST_CTE)
def rolling_backtest(spark, d):
    rows = bt.rolling_backtest(_features(spark, d), "entity", "period", ["pop_lag1"], "population", FIRST_TEST)
    return rounded(rows, mae=0, rmse=0)


def _fit_line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]


def _use_line(model: np.ndarray, x: np.ndarray) -> np.ndarray:
    return model[0] + x @ model[1:]


@query("rolling_backtest_functions", BACKTEST_SQL, BACKTEST_CTE)
def rolling_backtest_functions(spark, d):
    rows = bt.rolling_backtest_with(_features(spark, d), "entity", "period", ["pop_lag1"], "population", FIRST_TEST, _fit_line, _use_line)
    return rounded(rows, mae=0, rmse=0)


RIDGE_RUN = (
    ",\nrun_m AS (SELECT entity, period, population, "
    + ", ".join(REGRESSORS)
    + ", "
    + moments_sql(REGRESSORS, "population", BEFORE, alpha=1.0)
    + " FROM mfeat),\n"
    + f"run_t AS (SELECT * FROM run_m WHERE period >= {FIRST_TEST} AND n >= 8),\n"
    + solve_sql("run", "run_t", 4)
)


@query(
    "rolling_backtest_nf",
    f"""SELECT entity, period AS split_year, {r('abs(e)', 0, 'mae')}, {r('abs(e)', 0, 'rmse')}, CAST(1 AS BIGINT) AS test_rows
        FROM (SELECT entity, period, my + {' + '.join(f'x_{i} * ({f} - m_{i})' for i, f in enumerate(REGRESSORS, 1))} - population AS e FROM run)""",
    RIDGE_RUN,
)
def rolling_backtest_nf(spark, d):
    from ..operators.regression import expanding_predictions

    predicted = expanding_predictions(_features(spark, d), "entity", "period", REGRESSORS, "population", FIRST_TEST, alpha=1.0)
    error = F.abs(F.col("yhat") - F.col("actual"))
    rows = predicted.filter(F.col("train_rows") >= 8).select(
        "entity", F.col("period").alias("split_year"), error.alias("mae"), error.alias("rmse"), F.lit(1).cast("bigint").alias("test_rows")
    )
    return rounded(rows, mae=0, rmse=0)


POOLED = " OVER (ORDER BY period RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(
    "pooled_backtest",
    f"""SELECT period AS split_year, {r('avg(abs(e))', 0, 'mae')}, {r('sqrt(avg(e * e))', 0, 'rmse')}, count(*) AS test_rows
        FROM (SELECT period, my + {' + '.join(f'x_{i} * ({f} - m_{i})' for i, f in enumerate(REGRESSORS, 1))} - population AS e FROM run)
        GROUP BY 1""",
    ",\nrun_m AS (SELECT entity, period, population, "
    + ", ".join(REGRESSORS)
    + ", "
    + moments_sql(REGRESSORS, "population", POOLED)
    + " FROM mfeat),\n"
    + f"run_t AS (SELECT * FROM run_m WHERE period >= {FIRST_TEST}),\n"
    + solve_sql("run", "run_t", 4),
)
def pooled_backtest(spark, d):
    return rounded(bt.pooled_backtest(_features(spark, d), "period", REGRESSORS, "population", FIRST_TEST), mae=0, rmse=0)


# ---- Projections and roll-forward ------------------------------------------------


@query(
    "project_mean_revert",
    f"SELECT entity, CAST(t AS INTEGER) AS period, {r('u', 9, 'rate')} FROM path WHERE k > 0",
    """,
path AS (
  SELECT entity, max(period) AS t, max_by(unemployment_rate, period) AS u, 0 AS k FROM mhist GROUP BY 1
  UNION ALL SELECT entity, t + 1, greatest(2.0, least(15.0, 4.5 + (u - 4.5) * 0.5)), k + 1 FROM path WHERE k < 10)""",
)
def project_mean_revert(spark, d):
    start = b.month_history(spark, d).groupBy("entity").agg(
        F.max("period").alias("last"), F.max_by("unemployment_rate", "period").alias("rate")
    )
    return rounded(fc.project_rate(start, "entity", "last", "rate", HORIZON, "period"), rate=9)


@query(
    "project_index_growth",
    f"""SELECT entity, CAST(t + k AS INTEGER) AS period, {r('c * pow(1 + 0.6 * g + 0.4 * 0.025, k)', 4, 'index')}
        FROM (SELECT entity, max(period) AS t, max_by(rent_cpi_index, period) AS c,
                coalesce(pow(max_by(rent_cpi_index, period) / min_by(rent_cpi_index, period), 1.0 / nullif(count(*) - 1, 0)) - 1, 0) AS g
              FROM (SELECT * FROM mhist QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) <= 6) GROUP BY 1),
             (SELECT unnest(range(1, 11)) AS k) s""",
)
def project_index_growth(spark, d):
    history = b.month_history(spark, d)
    growth = p.recent_stats(history, "entity", "period", "rent_cpi_index", fc.LOOKBACK).select("entity", "cagr")
    start = history.groupBy("entity").agg(F.max("period").alias("last"), F.max_by("rent_cpi_index", "period").alias("index"))
    return rounded(fc.project_index(start.join(growth, "entity"), "entity", "last", "index", "cagr", HORIZON, "period"), index=4)


ROLL_CTE = FIT_SQL + ",\n" + roll_sql("roll", "mfeat", "fit", "entity", "period", f"t0 + {HORIZON}")


@query(
    "roll_forward",
    f"""SELECT entity, period, {r('yhat', 0, 'yhat')}, {r('unemployment_rate', 9, 'unemployment_rate')}, {r('rent_cpi_index', 4, 'rent_cpi_index')},
          {r('pop_lag1', 0, 'pop_lag1')}, {r('pop_lag5', 0, 'pop_lag5')} FROM roll""",
    ROLL_CTE,
)
def roll_forward(spark, d):
    rows = fc.roll_forward(_features(spark, d), _ridge(spark, d), "entity", "period", REGRESSORS, horizon=HORIZON)
    return rounded(rows.drop("pop_ma3"), yhat=0, unemployment_rate=9, rent_cpi_index=4, pop_lag1=0, pop_lag5=0)


@query(
    "future_features",
    f"""SELECT entity, period, {r('pop_lag1', 0, 'pop_lag1')}, {r('pop_lag5', 0, 'pop_lag5')}, {r('unemployment_rate', 9, 'unemployment_rate')},
          {r('rent_cpi_index', 4, 'rent_cpi_index')}, {r('yhat', 0, 'population_implied')} FROM roll""",
    ROLL_CTE,
)
def future_features(spark, d):
    rows = fc.future_features(_features(spark, d), _ridge(spark, d), "entity", "period", REGRESSORS, horizon=HORIZON)
    return rounded(rows, population_implied=0, unemployment_rate=9, rent_cpi_index=4, pop_lag1=0, pop_lag5=0)


START, END = 24001, 24030


@query(
    "predict",
    f"""SELECT entity, period, {r(score_sql(REGRESSORS), 0, 'yhat')}, 'covered' AS kind FROM mfeat JOIN fit USING (entity) WHERE period BETWEEN {START} AND {END}
        UNION ALL SELECT entity, period, {r('yhat', 0, 'yhat')}, 'future' FROM roll WHERE period >= {START}""",
    FIT_SQL + ",\n" + roll_sql("roll", "mfeat", "fit", "entity", "period", str(END)),
)
def predict(spark, d):
    return rounded(fc.predict(_features(spark, d), _ridge(spark, d), "entity", "period", REGRESSORS, START, END), yhat=0)


# ---- Evaluation --------------------------------------------------------------------

TWO_FITS = (
    ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", REGRESSORS, alpha=1.0)
    + ",\n" + fit_sql("one", "mtrain", "entity", ["pop_lag1"])
    + f""",
scores AS (
  SELECT entity, period, population AS actual, {score_sql(REGRESSORS, 'fit.')} AS yhat_ridge, one.x0 + one.x_1 * pop_lag1 AS yhat_linear
  FROM mfeat JOIN fit USING (entity) JOIN one USING (entity) WHERE period >= {SPLIT} AND fit.n >= 8)"""
)


def _two_models(spark, d):
    train, test = _train(spark, d), _features(spark, d).filter(~bt.is_train("period", SPLIT, inclusive=False))
    ridge = _enough(fit_linear(train, "entity", REGRESSORS, "population", alpha=1.0))
    line = _enough(fit_linear(train, "entity", ["pop_lag1"], "population"))
    scored = fc.predict_known(test, ridge, "entity", "period", REGRESSORS).withColumn("model", F.lit("ridge"))
    scored = scored.unionByName(
        fc.predict_known(test, line, "entity", "period", ["pop_lag1"]).withColumn("model", F.lit("linear"))
    )
    wide = bt.wide_predictions(scored, "entity", "period", ["linear", "ridge"])
    return wide.join(test.select("entity", "period", F.col("population").alias("actual")), ["entity", "period"])


def _evaluation_sql(model):
    e = f"(yhat_{model} - actual)"
    return f"""SELECT '{model}' AS model, {r(f'avg(abs({e}))', 0, 'mae')}, {r(f'avg({e} * {e}) / 1e9', 1, 'mse')}, {r(f'sqrt(avg({e} * {e}))', 0, 'rmse')},
      {r(f'1 - sum({e} * {e}) / (var_pop(actual) * count(*))', 6, 'r2')}, {r(f'avg(abs({e}) / abs(actual)) * 100', 4, 'mape')} FROM scores"""


@query("evaluate_models", _evaluation_sql("linear") + " UNION ALL " + _evaluation_sql("ridge"), TWO_FITS)
def evaluate_models(spark, d):
    table = bt.evaluate_models(_two_models(spark, d), [], ["linear", "ridge"])
    return rounded(table.withColumn("mse", F.col("mse") / 1e9), mae=0, mse=1, rmse=0, r2=6, mape=4)


@query("model_table_by_mae", "SELECT model, mae FROM (" + _evaluation_sql("linear") + " UNION ALL " + _evaluation_sql("ridge") + ") ORDER BY mae", TWO_FITS)
def model_table_by_mae(spark, d):
    return rounded(bt.evaluate_models(_two_models(spark, d), [], ["linear", "ridge"]).select("model", "mae"), mae=0).orderBy("mae")


@query("residuals", f"SELECT entity, period, {r('actual - yhat_linear', 0, 'residual')} FROM scores", TWO_FITS)
def residuals(spark, d):
    rows = bt.residuals(_two_models(spark, d), predicted="yhat_linear")
    return rounded(rows.select("entity", "period", "residual"), residual=0)


@query("train_all")
def train_all(spark, d):
    """All four families over the months of every nation whose data is new."""
    rows = b.month_features(spark, d).select(
        F.lpad((F.col("entity") + 1).cast("string"), 2, "0").alias("geo_code"),
        F.col("period").alias("year"),
        "population",
        *REGRESSORS,
    )
    matrix = checkpointed(
        rows.withColumns({c: F.lit(0.0) for c in ["pop_ma3", "pop_yoy_growth_pct", "pop_cagr_5yr_pct"]}).withColumn(
            "has_full_features", F.lit(True)
        )
    )
    pointers = spark.createDataFrame([], "geo_code string, model string, data_hash string")
    people = matrix.select("geo_code", "year", "population")
    runs, _, metrics = run_training(matrix, people, pointers, REGRESSORS, split=SPLIT, horizon=HORIZON)
    return runs.join(metrics, "run_id").select("geo_code", "model", "scope", "metric", "value", "train_rows", "test_rows")


@query("train_family_linear", f"SELECT entity, period, {r(score_sql(['pop_lag1']), 0, 'yhat')} FROM mfeat JOIN fit USING (entity)", ",\n" + TRAIN_SQL + ",\n" + fit_sql("fit", "mtrain", "entity", ["pop_lag1"]))
def train_family_linear(spark, d):
    rows = _features(spark, d).withColumnsRenamed({"entity": "geo_code", "period": "year"})
    _, forecasts = train_family(rows, "linear", ["pop_lag1"], split=SPLIT, horizon=0)
    return rounded(forecasts.select(F.col("geo_code").alias("entity"), F.col("year").alias("period"), "yhat"), yhat=0)
