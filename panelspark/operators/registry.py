"""Run registry: metrics, leaderboards, pointers, and what needs training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.guarded import iso_utc
from .ranking import newest_first, nulls_last, top_per_group, with_row_number
from .upsert import update_from, upsert

TEST_SCOPE = "test"
MISSING_RMSE = 1e9


def model_headline(metrics: DataFrame) -> DataFrame:
    """Best test r2, rmse and mae of each run."""

    def of(name: str):
        return F.when((F.col("metric") == name) & (F.col("scope") == TEST_SCOPE), F.col("value"))

    return metrics.groupBy("run_id").agg(
        F.max(of("r2")).alias("r2_test"), F.min(of("rmse")).alias("rmse_test"), F.min(of("mae")).alias("mae_test")
    )


def scored_runs(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    return runs.select("geo_code", "model", "run_id", "trained_at").join(model_headline(metrics), "run_id", "left")


def leaderboard(runs: DataFrame, metrics: DataFrame, smallest_split: int = 100_000) -> DataFrame:
    """Rank of every run within its area, and within area and model."""
    order = [*nulls_last("rmse_test"), newest_first("trained_at"), F.col("run_id")]
    scored = scored_runs(runs, metrics)
    ranked = with_row_number(scored, ["geo_code", "model"], order, "rank_within_model", smallest_split)
    return with_row_number(ranked, ["geo_code"], order, "rank_within_geo_code", smallest_split)


def scorecard(runs: DataFrame, metrics: DataFrame, areas: list[str] | None = None) -> DataFrame:
    """Newest run of each model, ranked within the area. Empty for unknown areas."""
    if areas is not None:
        runs = runs.filter(F.col("geo_code").isin(areas))
    newest = top_per_group(runs, ["geo_code", "model"], [F.desc("trained_at"), F.desc("run_id")])
    # One row per area and model is left, so the window is as small as the list of models.
    order = [F.col("rmse_test").asc_nulls_last(), F.desc("trained_at"), F.col("run_id")]
    rank = F.row_number().over(W.partitionBy("geo_code").orderBy(*order))
    ranked = scored_runs(newest, metrics).withColumn("rank_within_geo_code", rank)
    return ranked.withColumn("trained_at", iso_utc(F.col("trained_at")))


def best_model(card: DataFrame) -> DataFrame:
    return card.filter(F.col("rank_within_geo_code") == 1).select("geo_code", F.col("model").alias("best_model"), "run_id")


def display_order(card: DataFrame) -> DataFrame:
    """Leaderboard as shown: a missing error sorts as a very large one."""
    return card.orderBy("geo_code", F.coalesce("rmse_test", F.lit(MISSING_RMSE)), "run_id")


def best_run(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Run with the lowest test rmse per area and model; ties go to the highest id."""
    rmse = F.when((F.col("metric") == "rmse") & (F.col("scope") == TEST_SCOPE), F.col("value"))
    lowest = metrics.groupBy("run_id").agg(F.min(rmse).alias("rmse_test"))
    scored = runs.select("geo_code", "model", "run_id").join(lowest, "run_id", "left")
    return top_per_group(scored, ["geo_code", "model"], [F.col("rmse_test").asc_nulls_last(), F.desc("run_id")])


POINTER_COLUMNS = {
    "latest_run_id": "run_id",
    "trained_at": "trained_at",
    "data_hash": "data_hash",
    "rows": "rows",
    "year_min": "year_min",
    "year_max": "year_max",
    "artifact_path": "artifact_path",
}


def ensure_pointers(pointers: DataFrame, runs: DataFrame) -> DataFrame:
    """A pointer row for every area and model that has a run; existing rows stay."""
    first = runs.select("geo_code", "model", "data_hash", "trained_at")
    return upsert(pointers, first, ["geo_code", "model"], order="trained_at", on_conflict="ignore")


def point_latest_and_best(pointers: DataFrame, runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Newest and best run of each area and model on its pointer row."""
    newest = top_per_group(runs, ["geo_code", "model"], [F.desc("trained_at"), F.desc("run_id")])
    known = {dst: src for dst, src in POINTER_COLUMNS.items() if src in runs.columns and dst in pointers.columns}
    latest = update_from(pointers, newest, ["geo_code", "model"], known)
    return update_from(latest, best_run(runs, metrics), ["geo_code", "model"], {"best_run_id": "run_id"})


def qualifying_entities(matrix: DataFrame, min_years: int = 8, require_full: bool = True) -> DataFrame:
    rows = matrix.filter("has_full_features") if require_full else matrix
    return rows.groupBy("geo_code").agg(F.count("*").alias("years")).filter(F.col("years") >= min_years)


def drift_todo(live: DataFrame, pointers: DataFrame, models: list[str], force: bool = False) -> DataFrame:
    """Area and model pairs whose data changed since the recorded training.

    The models are a short literal list, so pairing multiplies the areas by a
    constant without a shuffle.
    """
    pairs = live.select("geo_code", F.col("data_hash").alias("live_hash")).withColumn(
        "model", F.explode(F.array(*[F.lit(m) for m in models]))
    )
    stored = pointers.select("geo_code", "model", F.col("data_hash").alias("stored_hash"))
    joined = pairs.join(stored, ["geo_code", "model"], "left")
    return joined if force else joined.filter(~F.col("stored_hash").eqNullSafe(F.col("live_hash")))
