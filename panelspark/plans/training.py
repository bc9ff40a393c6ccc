"""Training of all areas and models whose data changed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.guarded import year_end
from ..operators.backtest import is_train
from ..operators.boosted import ROUNDS
from ..operators.forecast import backcast_and_naive_future
from ..operators.hashtree import root_hashes
from ..operators.metrics import as_metric_rows, forecast_metrics
from ..operators.panel import fingerprint, union_all
from ..operators.registry import drift_todo, ensure_pointers, point_latest_and_best, qualifying_entities
from ..operators.regression import fit_linear
from ..operators.trend import fit_trend, score_trend
from ..operators.trees import TREE_MODEL, fit_trees
from ..session import stored
from ..sources.models import load_models, save_models
from ..sources.snapshots import publish, read_snapshot
from ..sources.variants import fields, parsed
from .features import HASHED_COLUMNS
from .serve import attach_actuals

# ---- Fixed values: training defaults -------------------------------------------
MIN_YEARS = 8
SPLIT_YEAR = 2020
HORIZON = 10
RIDGE_ALPHA = 1.0
FAMILIES = ["prophet", "linear", "ridge", "xgb"]
# ---------------------------------------------------------------------------------


def training_plan(
    matrix: DataFrame,
    pointers: DataFrame,
    models: list[str],
    *,
    min_years: int = MIN_YEARS,
    force: bool = False,
    areas: list[str] | None = None,
    skip: list[str] | None = None,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """Area and model pairs to train: enough years, and data that differs from the last run.

    Named ``areas`` are taken instead of those with enough years; models to ``skip`` are left out.
    With ``leaves``, the stored hashes of the matrix's blocks, the matrix is not read at all.
    Their hashes differ from those of whole histories, so a root keeps to one kind.
    """
    models = [m for m in models if m not in (skip or [])]
    if leaves is not None:
        chosen = F.col("geo_code").isin(areas) if areas is not None else F.col("full_rows") >= min_years
        return drift_todo(root_hashes(leaves, "geo_code").filter(chosen), pointers, models, force)
    if areas is not None:
        qualified = matrix.filter(F.col("geo_code").isin(areas)).select("geo_code").distinct()
    else:
        qualified = qualifying_entities(matrix, min_years)
    live = fingerprint(matrix.join(qualified.select("geo_code"), "geo_code", "left_semi"), "geo_code", "year", HASHED_COLUMNS)
    return drift_todo(live, pointers, models, force)


def _carried_rows(matrix: DataFrame, features: list[str], horizon: int) -> DataFrame:
    last = matrix.groupBy("geo_code").agg(F.max("year").alias("_last"), *[F.max_by(f, "year").alias(f) for f in features])
    ahead = last.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    future = ahead.withColumn("year", (F.col("_last") + F.col("_step")).cast("int")).drop("_last", "_step")
    return matrix.select("geo_code", "year", *features).unionByName(future)


def train_family(
    matrix: DataFrame, model: str, features: list[str], *, split: int, horizon: int, alpha: float = RIDGE_ALPHA, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """Models and forecasts of one family for all areas in one job."""
    train = matrix.filter(is_train("year", split))
    if model in ("linear", "ridge"):
        coefs = fit_linear(train, "geo_code", features, "population", alpha=alpha if model == "ridge" else 0.0)
        forecasts = backcast_and_naive_future(matrix, coefs, "geo_code", "year", features, horizon)
    elif model == "prophet":
        coefs = fit_trend(train, "geo_code", "year", "population", features)
        forecasts = score_trend(_carried_rows(matrix, features, horizon), coefs, "geo_code", "year", features)
    elif model == TREE_MODEL:
        coefs = fit_trees(train, "geo_code", "year", features, "population", rounds=rounds)
        coefs = stored(coefs, "trees")  # grown once for keeping and for forecasts
        forecasts = backcast_and_naive_future(matrix, coefs, "geo_code", "year", features, horizon)
    else:
        raise ValueError(f"invalid model: {model}")
    interval = [c for c in ("yhat_lo", "yhat_hi") if c in forecasts.columns]
    return coefs, forecasts.select("geo_code", "year", F.lit(model).alias("model"), "yhat", *interval)


def dated_forecasts(forecasts: DataFrame, population: DataFrame) -> DataFrame:
    """Forecasts at year end with the actual value beside them."""
    return attach_actuals(forecasts.withColumn("ds", year_end(F.col("year"))).drop("year"), population)


def run_metrics(dated: DataFrame, by: list[str], split: int) -> DataFrame:
    """Errors over all known years, and over the years after the split only."""
    everything = as_metric_rows(forecast_metrics(dated, by), by, "test")
    held_out = as_metric_rows(forecast_metrics(dated.filter(F.year("ds") > split), by), by, "holdout")
    return everything.unionByName(held_out)


def run_id_of(split: int, batch: str) -> Column:
    """Run ids derive from area, model, data, split and the job's batch: a task that
    runs twice yields the same id, a second job other ones."""
    return F.md5(F.concat_ws("|", "geo_code", "model", "live_hash", F.lit(str(split)), F.lit(batch))).alias("run_id")


def run_rows(matrix: DataFrame, todo: DataFrame, features: list[str], split: int, horizon: int, batch: str) -> DataFrame:
    """One registry row per trained pair, with its data span and settings."""
    sizes = matrix.groupBy("geo_code").agg(
        F.count("*").alias("rows"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.count_if(is_train("year", split)).alias("train_rows"),
        F.count_if(~is_train("year", split)).alias("test_rows"),
    )
    params = F.to_json(
        F.struct(
            F.array(*[F.lit(f) for f in features]).alias("features"),
            F.when(F.col("model") == "ridge", F.lit(RIDGE_ALPHA)).alias("alpha"),
        )
    )
    runs = todo.select(run_id_of(split, batch), "geo_code", "model", F.col("live_hash").alias("data_hash"))
    return runs.join(sizes, "geo_code").withColumns(
        {"split_year": F.lit(split), "horizon": F.lit(horizon), "params": params}
    )


def train_all(
    matrix: DataFrame,
    population: DataFrame,
    pointers: DataFrame,
    features: list[str],
    *,
    models: list[str] | None = None,
    min_years: int = MIN_YEARS,
    split: int = SPLIT_YEAR,
    horizon: int = HORIZON,
    rounds: int = ROUNDS,
    force: bool = False,
    areas: list[str] | None = None,
    skip: list[str] | None = None,
    leaves: DataFrame | None = None,
    batch: str | None = None,
    keep_models: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run rows, forecasts and metrics of every pair the plan lists.

    One job per family covers all its areas. ``keep_models`` receives the
    coefficients of each family with their run ids.
    """
    models = [m for m in models or FAMILIES if m not in (skip or [])]
    if not models:
        raise ValueError("no model is left to train")
    if leaves is None:
        matrix = stored(matrix, "matrix")  # hashed, counted, fitted and scored from the same rows
    plan = training_plan(matrix, pointers, models, min_years=min_years, force=force, areas=areas, leaves=leaves)
    todo = stored(plan, "todo")
    if leaves is not None:  # only areas that are due
        matrix = stored(matrix.join(todo.select("geo_code").distinct(), "geo_code", "left_semi"), "matrix")
    batch = batch or uuid.uuid4().hex
    runs = run_rows(matrix, todo, features, split, horizon, batch)
    ids = todo.select(run_id_of(split, batch), "geo_code", "model")
    parts = []
    for model in models:
        due = todo.filter(F.col("model") == model).select("geo_code")
        if due.isEmpty():
            continue
        own = matrix.join(due, "geo_code", "left_semi")
        coefs, forecasts = train_family(own, model, features, split=split, horizon=horizon, rounds=rounds)
        if keep_models is not None:
            keep_models(coefs.join(ids, ["geo_code", "model"]))
        parts.append(forecasts)
    if not parts:
        parts = [todo.limit(0).select("geo_code", F.lit(0).alias("year"), "model", F.lit(0.0).alias("yhat"))]
    dated = dated_forecasts(union_all(parts, relaxed=True), population).join(ids, ["geo_code", "model"])
    return runs, dated, run_metrics(dated, ["run_id"], split)


POINTER_SCHEMA = (
    "geo_code string, model string, data_hash string, trained_at timestamp, rows bigint, year_min int, year_max int,"
    " artifact_path string, latest_run_id string, best_run_id string"
)


def record_training(root: str, matrix: DataFrame, population: DataFrame, features: list[str], **options) -> int:
    """The nightly job: train what changed and record it below ``root``.

    Coefficients, forecasts, metrics and runs are appended, then a new version
    of the pointers is published. Returns the number of recorded runs. A job
    that dies before the last step leaves the pointers as they were, and the
    next one trains the same pairs again.
    """
    spark = matrix.sparkSession
    schema = spark.createDataFrame([], POINTER_SCHEMA).schema
    pointers = read_snapshot(spark, f"{root}/pointers", schema)
    runs, dated, _ = train_all(
        matrix, population, pointers, features, **options, keep_models=lambda c: save_models(c, f"{root}/models", "geo_code")
    )
    fresh = stored(
        runs.withColumns({"trained_at": F.current_timestamp(), "artifact_path": F.concat(F.lit(f"{root}/models/model="), "model")}),
        "runs",
    )
    count = fresh.count()
    if count == 0:
        return 0
    kept = stored(dated, "forecasts")
    split = options.get("split", SPLIT_YEAR)
    kept.write.mode("append").partitionBy("model").parquet(f"{root}/forecasts")
    run_metrics(kept, ["run_id"], split).write.mode("append").parquet(f"{root}/metrics")
    fresh.write.mode("append").parquet(f"{root}/runs")
    known, measured = spark.read.parquet(f"{root}/runs"), spark.read.parquet(f"{root}/metrics")
    pointed = point_latest_and_best(ensure_pointers(pointers, fresh), known, measured)
    publish(pointed, f"{root}/pointers")
    return count


def run_settings(runs: DataFrame) -> DataFrame:
    """Recorded runs with their parameters as Variant, and the features and penalty they name."""
    wanted = {"used_features": ("$.features", "array<string>"), "alpha": ("$.alpha", "double")}
    return fields(parsed(runs, "params"), "params", wanted)


def serving_models(spark: SparkSession, root: str, run_ids: list[str] | None = None) -> DataFrame:
    """Coefficients of each area and model's best run, or of the given runs."""
    coefs = load_models(spark, f"{root}/models").dropDuplicates(["run_id"])
    if run_ids is not None:
        return coefs.filter(F.col("run_id").isin(run_ids))
    best = read_snapshot(spark, f"{root}/pointers").select(F.col("best_run_id").alias("run_id"))
    return coefs.join(best, "run_id", "left_semi")
