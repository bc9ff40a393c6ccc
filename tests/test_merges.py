import pytest
from pyspark.sql import functions as F

from panelspark.operators import registry as g
from panelspark.operators.upsert import append_if_absent, update_from, upsert

SCHEMA = "k int, a int, b string"
ORDERED = "k int, a int, b string, n int"


def frames(spark):
    target = spark.createDataFrame([(1, 10, "x"), (2, 20, None)], SCHEMA)
    updates = spark.createDataFrame([(2, 21, "p", 1), (2, None, "q", 2), (3, 30, "r", 1)], ORDERED)
    return target, updates


def test_last_update_wins_and_null_overwrites(spark, rows):
    target, updates = frames(spark)
    assert rows(upsert(target, updates, ["k"], order="n")) == [(1, 10, "x"), (2, None, "q"), (3, 30, "r")]


def test_partial_update_keeps_other_columns(spark, rows):
    target, updates = frames(spark)
    assert rows(upsert(target, updates, ["k"], order="n", update_cols=["b"])) == [(1, 10, "x"), (2, 20, "q"), (3, 30, "r")]


def test_ignore_keeps_stored_rows_and_inserts_the_first(spark, rows):
    target, updates = frames(spark)
    twice = updates.unionByName(spark.createDataFrame([(3, 99, "late", 9)], ORDERED))
    assert rows(upsert(target, twice, ["k"], order="n", on_conflict="ignore")) == [(1, 10, "x"), (2, 20, None), (3, 30, "r")]


def test_merge_is_idempotent_and_empty_updates_do_nothing(spark, rows):
    target, updates = frames(spark)
    once = upsert(target, updates, ["k"], order="n")
    assert rows(upsert(once, updates, ["k"], order="n")) == rows(once)
    assert rows(upsert(target, updates.limit(0), ["k"], order="n")) == rows(target)
    assert rows(upsert(target.limit(0), updates, ["k"], order="n")) == [(2, None, "q"), (3, 30, "r")]


def test_unknown_policy(spark):
    target, updates = frames(spark)
    with pytest.raises(ValueError):
        upsert(target, updates, ["k"], on_conflict="merge")


def test_append_takes_first_of_new_keys(spark, rows):
    target, updates = frames(spark)
    assert rows(append_if_absent(target, updates, ["k"], order="n")) == [(3, 30, "r")]
    assert append_if_absent(target, target, ["k"]).count() == 0


def test_update_from_touches_matches_only(spark, rows):
    target, updates = frames(spark)
    source = updates.filter("n = 2").withColumnRenamed("b", "name")
    assert rows(update_from(target, source, ["k"], {"b": "name", "a": "a"})) == [(1, 10, "x"), (2, None, "q")]


def registry(spark):
    runs = spark.createDataFrame(
        [("r1", "06", "linear", "2024-01-01"), ("r2", "06", "linear", "2024-01-02"), ("r3", "06", "ridge", "2024-01-01"), ("r4", "06", "ridge", "2024-01-01"), ("r5", "07", "xgb", "2024-01-01")],
        "run_id string, geo_code string, model string, day string",
    ).withColumn("trained_at", F.to_timestamp("day")).withColumn("data_hash", F.col("run_id"))
    metrics = spark.createDataFrame(
        [("r1", "rmse", "test", -1, 1.0), ("r2", "rmse", "test", -1, 2.0), ("r3", "rmse", "test", -1, 5.0), ("r4", "rmse", "test", -1, 5.0), ("r5", "rmse", "train", -1, 1.0)],
        "run_id string, metric string, scope string, fold int, value double",
    )
    return runs, metrics


def test_leaderboard_best_run_and_scorecard(spark, rows):
    runs, metrics = registry(spark)
    board = g.leaderboard(runs, metrics)
    assert rows(board, "run_id", "rank_within_model", "rank_within_geo_code") == [
        ("r1", 1, 1), ("r2", 2, 2), ("r3", 1, 3), ("r4", 2, 4), ("r5", 1, 1),
    ]
    assert rows(g.best_run(runs, metrics), "geo_code", "model", "run_id") == [("06", "linear", "r1"), ("06", "ridge", "r4"), ("07", "xgb", "r5")]
    card = g.scorecard(runs, metrics)
    assert rows(card, "run_id", "rank_within_geo_code") == [("r2", 1), ("r4", 2), ("r5", 1)]
    assert rows(g.best_model(card), "geo_code", "best_model") == [("06", "linear"), ("07", "xgb")]
    assert g.scorecard(runs, metrics, ["nowhere"]).count() == 0


def test_leaderboard_of_a_crowded_area(spark):
    n = 4000
    runs = spark.range(n).select(
        F.format_string("r%06d", "id").alias("run_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("g%d", F.col("id") % 50)).alias("geo_code"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("model"),
        F.timestamp_seconds(F.col("id") % 97).alias("trained_at"),
    )
    metrics = runs.select("run_id", F.lit("rmse").alias("metric"), F.lit("test").alias("scope"), F.lit(-1).alias("fold"), F.when(F.col("model") == "a", F.hash("run_id") % 11).cast("double").alias("value"))
    split, plain = g.leaderboard(runs, metrics, smallest_split=50), g.leaderboard(runs, metrics)
    assert split.count() == n and split.exceptAll(plain).count() == 0


def test_pointers_and_drift(spark, rows):
    runs, metrics = registry(spark)
    empty = spark.createDataFrame([], "geo_code string, model string, data_hash string, trained_at timestamp, latest_run_id string, best_run_id string")
    pointers = g.point_latest_and_best(g.ensure_pointers(empty, runs), runs, metrics)
    assert rows(pointers, "geo_code", "model", "latest_run_id", "best_run_id", "data_hash") == [
        ("06", "linear", "r2", "r1", "r2"), ("06", "ridge", "r4", "r4", "r4"), ("07", "xgb", "r5", "r5", "r5"),
    ]
    live = spark.createDataFrame([("06", "r2"), ("08", "new")], "geo_code string, data_hash string")
    assert rows(g.drift_todo(live, pointers, ["linear", "ridge"]), "geo_code", "model") == [
        ("06", "ridge"), ("08", "linear"), ("08", "ridge"),
    ]
    assert g.drift_todo(live, pointers, ["linear", "ridge"], force=True).count() == 4
