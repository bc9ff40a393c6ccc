import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import backtest as bt
from panelspark.operators import forecast as fc
from panelspark.operators.boosted import fit_boosted, score_boosted
from panelspark.operators.regression import fit_linear
from panelspark.operators.trend import fit_trend, score_trend
from panelspark.plans.features import REGRESSORS
from panelspark.plans.training import record_training, serving_models, train_all, training_plan
from panelspark.session import fresh_dir
from panelspark.sources.snapshots import read_snapshot

COLUMNS = "e string, t int, population double, pop_lag1 double, pop_lag5 double, unemployment_rate double, rent_cpi_index double"


def panel(entities=3, years=20, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(entities):
        level = 10.0 ** (3 + 2 * i)
        values = level * np.cumprod(1 + rng.normal(0.01, 0.01, years + 5))
        rate, index = rng.uniform(3, 8, years + 5), 100 * np.cumprod(1 + rng.normal(0.02, 0.005, years + 5))
        rows += [
            (f"e{i}", 2000 + t - 5, float(values[t]), float(values[t - 1]), float(values[t - 5]), float(rate[t]), float(index[t]))
            for t in range(5, years + 5)
        ]
    return rows


def by_entity(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {e: np.array([r[2:] for r in rs], dtype=float) for e, rs in out.items()}


def close(a, b, tolerance=1e-7):
    np.testing.assert_allclose(np.asarray(a, float), np.asarray(b, float), rtol=tolerance, atol=tolerance)


@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_fit_equals_least_squares(spark, alpha):
    rows = panel()
    fitted = fit_linear(spark.createDataFrame(rows, COLUMNS), "e", REGRESSORS, "population", alpha=alpha).collect()
    for row in fitted:
        data = by_entity(rows)[row["e"]]
        x, y = data[:, 1:], data[:, 0]
        xc, yc = x - x.mean(0), y - y.mean()
        if alpha:
            xc, yc = np.vstack([xc, math.sqrt(alpha) * np.eye(4)]), np.concatenate([yc, np.zeros(4)])
        coef = np.linalg.lstsq(xc, yc, rcond=None)[0]
        predicted = y.mean() + (x - x.mean(0)) @ coef
        close(row["intercept"] + x @ np.array(row["coef"]), predicted, 1e-6)


@pytest.mark.parametrize("kind", ["few rows", "constant", "collinear"])
def test_singular_systems_take_the_smallest_coefficients(spark, kind):
    rows = panel(1, 3 if kind == "few rows" else 12)
    if kind == "constant":
        rows = [(*r[:5], 4.0, r[6]) for r in rows]
    if kind == "collinear":
        rows = [(*r[:5], 2.0 * r[6], r[6]) for r in rows]
    fitted = fit_linear(spark.createDataFrame(rows, COLUMNS), "e", REGRESSORS, "population").first()
    data = by_entity(rows)["e0"]
    x, y = data[:, 1:], data[:, 0]
    expected = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-12)[0]
    close(fitted["coef"], expected, 1e-5)


def test_rows_with_gaps_are_left_out_and_empty_input_gives_nothing(spark):
    rows = panel(1, 10)
    gap = rows + [("e0", 2050, None, 1.0, 1.0, 1.0, 1.0), ("e0", 2051, 1.0, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(gap, COLUMNS)
    assert fit_linear(df, "e", REGRESSORS, "population").first()["train_rows"] == 10
    assert fit_linear(df.limit(0), "e", REGRESSORS, "population").count() == 0


def test_rolling_backtest_equals_refitting(spark):
    df = spark.createDataFrame(panel(2, 16), COLUMNS)

    def fit(x, y):
        return np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]

    fast = bt.rolling_backtest(df, "e", "t", ["pop_lag1", "unemployment_rate"], "population", 2008)
    slow = bt.rolling_backtest_with(df, "e", "t", ["pop_lag1", "unemployment_rate"], "population", 2008, fit, lambda m, x: m[0] + x @ m[1:])
    a = {(r["e"], r["split_year"]): r["mae"] for r in fast.collect()}
    b = {(r["e"], r["split_year"]): r["mae"] for r in slow.collect()}
    assert a.keys() == b.keys() and len(a) == 16
    for key in a:
        assert a[key] == pytest.approx(b[key], rel=1e-5, abs=1e-5)


def test_pooled_backtest_equals_refitting(spark):
    rows = panel(4, 14)
    found = {r["split_year"]: r for r in bt.pooled_backtest(spark.createDataFrame(rows, COLUMNS), "t", REGRESSORS, "population", 2005).collect()}
    assert sorted(found) == list(range(2005, 2014))
    for split, row in found.items():
        train = np.array([r[2:] for r in rows if r[1] < split], float)
        test = np.array([r[2:] for r in rows if r[1] == split], float)
        xc = train[:, 1:] - train[:, 1:].mean(0)
        coef = np.linalg.lstsq(xc, train[:, 0] - train[:, 0].mean(), rcond=None)[0]
        error = train[:, 0].mean() + (test[:, 1:] - train[:, 1:].mean(0)) @ coef - test[:, 0]
        assert row["mae"] == pytest.approx(np.abs(error).mean(), rel=1e-5) and row["test_rows"] == 4


def test_splits(spark):
    df = spark.createDataFrame([("e", y) for y in range(2018, 2023)], "e string, t int")
    row = bt.split_counts(df, "e", "t", 2020).first()
    assert tuple(row)[1:] == (3, 2, 2, 3)


# ---- Roll-forward against a plain loop ----------------------------------------------


def plain_roll(history, coef, intercept, delta, end):
    """One entity, one period at a time, from the specification."""
    pops = {t: v for t, v, _, _ in history if v is not None}
    order = [v for _, v, _, _ in history if v is not None]
    rates = [r for _, _, r, _ in history if r is not None] or [4.5]
    indexes = [c for _, _, _, c in history if c is not None]

    def growth(values, old):
        tail = values[-6:]
        return (tail[-1] / tail[0]) ** (1 / (len(tail) - 1)) - 1 if len(tail) > 1 and tail[0] > 0 else old

    def steps(values):
        diffs = np.diff(values[-6:])
        return (diffs.mean(), diffs.std()) if len(diffs) else (0.0, 0.0)

    g, (mean, std), gi = growth(order, 0.0), steps(order), growth(indexes, 0.025)
    out = []
    for y in range(history[-1][0] + 1, end + 1):
        rate = min(15.0, max(2.0, 4.5 + (rates[-1] - 4.5) * 0.5))
        previous = indexes[-1] if indexes else 0.0
        index = previous * (1 + 0.6 * gi + 0.4 * 0.025) if previous > 0 else previous
        lag1, lag5 = pops.get(y - 1), pops.get(y - 5)
        level = intercept + float(np.dot(coef, [lag1 or 0.0, lag5 or 0.0, rate, index]))
        level += (lag1 or 0.0) if delta else 0.0
        if lag1 is not None and lag1 > 0:
            blend = 0.7 * level + 0.3 * lag1 * (1 + g)
            if std > 0:
                yhat = lag1 + min(mean + 2 * std, max(mean - 2 * std, blend - lag1))
            else:
                yhat = max(lag1 * 0.95, min(lag1 * 1.05, blend))
        else:
            yhat = level
        pops[y] = yhat
        order.append(yhat), rates.append(rate), indexes.append(index)
        g, (mean, std), gi = growth(order, g), steps(order), growth(indexes, gi)
        out.append((y, yhat, rate, index))
    return out


HISTORIES = {
    "steady": [(t, 1000.0 + 10 * t, 5.0, 100.0 + t) for t in range(10)],
    "flat": [(t, 500.0, 4.5, 50.0) for t in range(10)],
    "short": [(9, 70.0, None, None)],
    "gap": [(t, 100.0 + (t * t) % 7, 20.0, 10.0) for t in (0, 1, 2, 4, 6, 9)],
    "unknown last": [(t, None if t > 7 else 90.0 + t, 1.0, None if t > 4 else 5.0 + t) for t in range(10)],
    "zero": [(t, 0.0, 3.0, 0.0) for t in range(10)],
    "noisy": [(t, 1e6 * (1 + 0.1 * math.sin(t)), 6.0 + t % 3, 200.0 + 3 * t) for t in range(10)],
}


@pytest.mark.parametrize("delta", [False, True])
def test_roll_forward_equals_a_plain_loop(spark, delta):
    coef, intercept = [0.6, 0.4, 3.0, -0.5], 12.0
    if delta:
        coef = [0.0, 0.01, 1.0, 0.0]
    rows = [(e, *h) for e, hs in HISTORIES.items() for h in hs]
    random.Random(5).shuffle(rows)
    history = spark.createDataFrame(rows, "e string, t int, population double, unemployment_rate double, rent_cpi_index double")
    coefs = spark.createDataFrame([(e, coef, intercept, delta) for e in HISTORIES], "e string, coef array<double>, intercept double, use_delta boolean")
    found = {}
    for r in fc.roll_forward(history, coefs, "e", "t", REGRESSORS, end=16).orderBy("t").collect():
        found.setdefault(r["e"], []).append((r["t"], r["yhat"], r["unemployment_rate"], r["rent_cpi_index"]))
    for entity, past in HISTORIES.items():
        close(found[entity], plain_roll(past, coef, intercept, delta, 16), 1e-9)


def test_forecast_steps_stay_in_the_clamp_band(spark):
    rows = [(*r[:3], r[5], r[6]) for r in panel(3, 12)]
    history = spark.createDataFrame(rows, "e string, t int, population double, unemployment_rate double, rent_cpi_index double")
    coefs = spark.createDataFrame([(f"e{i}", [50.0, 0.0, 0.0, 0.0], 0.0, False) for i in range(3)], "e string, coef array<double>, intercept double, use_delta boolean")
    first = fc.roll_forward(history, coefs, "e", "t", REGRESSORS, horizon=1).collect()
    for r in first:
        steps = np.diff([x[2] for x in rows if x[0] == r["e"]][-6:])
        assert r["yhat"] - r["pop_lag1"] == pytest.approx(steps.mean() + 2 * steps.std())


def test_history_window_changes_only_what_the_lags_see(spark):
    df = spark.createDataFrame(panel(1, 12), COLUMNS)
    coefs = spark.createDataFrame([("e0", [0.5, 0.5, 0.0, 0.0], 0.0, False)], "e string, coef array<double>, intercept double, use_delta boolean")
    full = fc.predict(df, coefs, "e", "t", REGRESSORS, 2010, 2013)
    window = fc.predict(df, coefs, "e", "t", REGRESSORS, 2010, 2013, history="window")
    kinds = [(r["t"], r["kind"]) for r in full.orderBy("t").collect()]
    assert kinds == [(2010, "covered"), (2011, "covered"), (2012, "future"), (2013, "future")]
    a, b = ({r["t"]: r["yhat"] for r in df_.collect()} for df_ in (full, window))
    assert a[2011] == b[2011] and a[2012] != b[2012]


def test_delta_models_add_the_lag_and_gaps_count_as_zero(spark, rows):
    df = spark.createDataFrame([("e", 1, 100.0, 3.0), ("e", 2, None, 3.0)], "e string, t int, pop_lag1 double, unemployment_rate double")
    coefs = spark.createDataFrame([("e", [0.0, 2.0], 1.0, True)], "e string, coef array<double>, intercept double, use_delta boolean")
    assert rows(fc.predict_known(df, coefs, "e", "t", ["pop_lag1", "unemployment_rate"]), "t", "yhat") == [(1, 107.0), (2, 7.0)]


def test_trend_follows_a_bend_and_its_interval_covers(spark):
    rng = np.random.default_rng(1)
    rows = [("e", t, 100.0 + 2 * t + (6 * (t - 20) if t > 20 else 0) + float(rng.normal(0, 0.5)), float(rng.normal())) for t in range(50)]
    df = spark.createDataFrame(rows, "e string, t int, y double, x double")
    scored = score_trend(df, fit_trend(df, "e", "t", "y", ["x"]), "e", "t", ["x"]).collect()
    error = [abs(r["yhat"] - r["y"]) for r in scored]
    assert np.mean(error) < 4 and all(r["yhat_lo"] <= r["yhat"] <= r["yhat_hi"] for r in scored)
    assert np.mean([r["yhat_lo"] <= r["y"] <= r["yhat_hi"] for r in scored]) > 0.7


def test_boosted_trees_keep_the_scale_of_each_entity(spark):
    df = spark.createDataFrame(panel(3, 15), COLUMNS)
    scored = score_boosted(df, fit_boosted(df, REGRESSORS, rounds=3), REGRESSORS).collect()
    assert len(scored) == 45 and all(abs(r["yhat"] / r["population"] - 1) < 0.1 for r in scored)


def test_training_is_gated_by_the_data_hash(spark):
    rows = panel(2, 12)
    matrix = spark.createDataFrame(rows, COLUMNS).withColumnsRenamed({"e": "geo_code", "t": "year"}).withColumns(
        {"pop_ma3": F.lit(0.0), "pop_yoy_growth_pct": F.lit(0.0), "pop_cagr_5yr_pct": F.lit(0.0), "has_full_features": F.lit(True)}
    )
    nothing = spark.createDataFrame([], "geo_code string, model string, data_hash string")
    plan = training_plan(matrix, nothing, ["linear", "ridge"])
    assert plan.count() == 4 and training_plan(matrix, nothing, ["linear"], min_years=13).count() == 0
    named = training_plan(matrix, nothing, ["linear", "ridge"], min_years=13, areas=["e1", "unknown"], skip=["ridge"])
    assert [(r["geo_code"], r["model"]) for r in named.collect()] == [("e1", "linear")]
    done = plan.filter("geo_code = 'e0'").select("geo_code", "model", F.col("live_hash").alias("data_hash"))
    assert {r["geo_code"] for r in training_plan(matrix, done, ["linear", "ridge"]).collect()} == {"e1"}
    people = matrix.select("geo_code", "year", "population")
    runs, forecasts, metrics = train_all(matrix, people, done, REGRESSORS, models=["linear", "prophet"], split=2008, horizon=3)
    assert {(r["geo_code"], r["model"], r["train_rows"], r["test_rows"]) for r in runs.collect()} == {
        ("e1", "linear", 9, 3), ("e1", "prophet", 9, 3), ("e0", "prophet", 9, 3)
    }
    assert forecasts.filter("model = 'linear'").count() == 15 and forecasts.filter("actual is null").count() == 9
    assert {r["scope"] for r in metrics.collect()} == {"test", "holdout"}


def test_recorded_training_serves_best_runs_and_rests_when_nothing_changed(spark):
    matrix = spark.createDataFrame(panel(2, 12), COLUMNS).withColumnsRenamed({"e": "geo_code", "t": "year"}).withColumns(
        {"pop_ma3": F.lit(0.0), "pop_yoy_growth_pct": F.lit(0.0), "pop_cagr_5yr_pct": F.lit(0.0), "has_full_features": F.lit(True)}
    )
    people, root = matrix.select("geo_code", "year", "population"), fresh_dir(spark, "registry")
    options = {"models": ["linear", "ridge"], "split": 2008, "horizon": 2}
    assert record_training(root, matrix, people, REGRESSORS, **options) == 4
    assert record_training(root, matrix, people, REGRESSORS, **options) == 0
    assert serving_models(spark, root).count() == 4
    changed = matrix.withColumn("population", F.when(F.col("geo_code") == "e0", F.col("population") + 1).otherwise(F.col("population")))
    assert record_training(root, changed, people, REGRESSORS, **options) == 2
    pointers = read_snapshot(spark, f"{root}/pointers").collect()
    assert len(pointers) == 4 and all(r["latest_run_id"] and r["best_run_id"] and r["rows"] == 12 for r in pointers)
    assert serving_models(spark, root).count() == 4
    assert serving_models(spark, root, [pointers[0]["latest_run_id"]]).count() == 1
    predicted = fc.predict(matrix, serving_models(spark, root).filter("model = 'ridge'"), "geo_code", "year", REGRESSORS, 2005, 2015)
    assert predicted.filter("kind = 'future'").count() == 2 * 4
