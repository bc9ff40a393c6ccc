"""Lags, averages, rankings and choices per entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions.guarded import iso_utc
from ..operators import annual as a
from ..operators import panel as p
from ..operators import registry as g
from .base import query, r, rounded


@query(
    "lags",
    "SELECT entity, period, value, lag(value, 1) OVER w AS lag1, lag(value, 5) OVER w AS lag5 FROM mpanel WINDOW w AS (PARTITION BY entity ORDER BY period)",
)
def lags(spark, d):
    return p.with_lags(b.month_panel(spark, d), "entity", "period", "value", {1: "lag1", 5: "lag5"})


@query(
    "lag_by_value",
    "SELECT m.entity, m.period, m.value, x.value AS lag1, y.value AS lag5 FROM mpanel m LEFT JOIN mpanel x ON x.entity = m.entity AND x.period = m.period - 1 LEFT JOIN mpanel y ON y.entity = m.entity AND y.period = m.period - 5",
)
def lag_by_value(spark, d):
    return p.with_lags_by_value(b.month_panel(spark, d), "entity", "period", "value", {1: "lag1", 5: "lag5"})


@query(
    "moving_avg",
    f"SELECT entity, period, {r('avg(value) OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 0, 'ma3')} FROM mpanel",
)
def moving_avg(spark, d):
    rows = p.with_moving_average(b.month_panel(spark, d), "entity", "period", "value", 3, "ma3")
    return rounded(rows.drop("value"), ma3=0)


ISO = "strftime(trained_at, '%Y-%m-%dT%H:%M:%SZ') AS trained_at"


@query(
    "leaderboard",
    f"""SELECT geo_code, model, run_id, {ISO}, rmse_test, mae_test, r2_test,
          CAST(row_number() OVER (PARTITION BY geo_code, model ORDER BY rmse_test ASC NULLS LAST, s.trained_at DESC, run_id) AS INTEGER) AS rank_within_model,
          CAST(row_number() OVER (PARTITION BY geo_code ORDER BY rmse_test ASC NULLS LAST, s.trained_at DESC, run_id) AS INTEGER) AS rank_within_geo_code
        FROM scored s""",
)
def leaderboard(spark, d):
    ranked = g.leaderboard(b.runs(spark, d), b.metrics(spark, d))
    return ranked.withColumn("trained_at", iso_utc(F.col("trained_at")))


@query(
    "scorecard",
    f"SELECT geo_code, model, run_id, {ISO}, rmse_test, mae_test, r2_test, CAST(rank_within_geo_code AS INTEGER) AS rank_within_geo_code FROM card",
)
def scorecard(spark, d):
    return g.scorecard(b.runs(spark, d), b.metrics(spark, d))


@query("best_model", "SELECT geo_code, model AS best_model, run_id FROM card WHERE rank_within_geo_code = 1")
def best_model(spark, d):
    return g.best_model(g.scorecard(b.runs(spark, d), b.metrics(spark, d)))


@query(
    "leaderboard_display",
    "SELECT geo_code, model, coalesce(rmse_test, 1e9) AS shown_rmse, run_id FROM card",
)
def leaderboard_display(spark, d):
    card = g.display_order(g.scorecard(b.runs(spark, d), b.metrics(spark, d)))
    return card.select("geo_code", "model", F.coalesce("rmse_test", F.lit(g.MISSING_RMSE)).alias("shown_rmse"), "run_id")


@query(
    "best_run",
    """SELECT geo_code, model, run_id, rmse_test FROM scored
       QUALIFY row_number() OVER (PARTITION BY geo_code, model ORDER BY rmse_test ASC NULLS LAST, run_id DESC) = 1""",
)
def best_run(spark, d):
    return g.best_run(b.runs(spark, d), b.metrics(spark, d))


@query(
    "registry_latest",
    """SELECT p.geo_code, p.model, l.run_id AS latest_run_id, l.data_hash, l.rows, l.year_min, l.year_max, l.artifact_path, x.run_id AS best_run_id
       FROM (SELECT DISTINCT geo_code, model FROM fx_runs) p
       JOIN (SELECT * FROM fx_runs QUALIFY row_number() OVER (PARTITION BY geo_code, model ORDER BY trained_at DESC, run_id DESC) = 1) l USING (geo_code, model)
       JOIN (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY geo_code, model ORDER BY rmse_test ASC NULLS LAST, run_id DESC) = 1) x USING (geo_code, model)""",
)
def registry_latest(spark, d):
    runs = b.runs(spark, d)
    stored = runs.filter(F.col("model") == "1-URGENT").select("geo_code", "model").distinct()
    blank = {c: F.lit(None).cast("string") for c in ["data_hash", "artifact_path", "latest_run_id", "best_run_id"]}
    numbers = {"rows": F.lit(None).cast("bigint"), "year_min": F.lit(None).cast("int"), "year_max": F.lit(None).cast("int")}
    pointers = g.ensure_pointers(stored.withColumns({**blank, **numbers, "trained_at": F.lit(None).cast("timestamp")}), runs)
    return g.point_latest_and_best(pointers, runs, b.metrics(spark, d)).select(
        "geo_code", "model", "latest_run_id", "data_hash", "rows", "year_min", "year_max", "artifact_path", "best_run_id"
    )


@query(
    "choose_canonical",
    """SELECT geo_code, geo_type, year, source, population FROM fx_survey
       QUALIFY row_number() OVER (PARTITION BY geo_code, year ORDER BY
         CASE WHEN geo_type = 'county' THEN source <> 'ACS5' ELSE source <> 'ACS1' END, source) = 1""",
)
def choose_canonical(spark, d):
    return a.choose_canonical(b.survey_rows(spark, d)).select("geo_code", "geo_type", "year", "source", "population")


@query(
    "last_known",
    """SELECT geo_code, max_by(unemployment_rate, year) FILTER (WHERE unemployment_rate IS NOT NULL) AS unemployment_rate,
         max_by(region_index, year) FILTER (WHERE region_index IS NOT NULL) AS region_index FROM joined GROUP BY 1""",
)
def last_known(spark, d):
    return p.last_known(b.joined(spark, d), "geo_code", "year", ["unemployment_rate", "region_index"])
