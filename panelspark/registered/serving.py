"""Composite serving queries over areas and years."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import codes
from ..operators.forecast import predict_known
from ..operators.registry import scorecard
from ..operators.regression import fit_linear
from ..operators.trees import fit_trees, tree_nodes
from ..plans import serve
from ..plans.export import export_bundle as write_bundle
from ..plans.features import REGRESSORS
from ..session import fresh_dir, stored
from ..sources.models import load_models, save_models
from .base import query, r, rounded
from .model_sql import fit_sql, roll_sql, score_sql, stump_columns, stump_score, stump_sql

END = 2004

# Models as plain data: last value times a factor, for states also in a second model.
COEF_SQL = """coefs AS (
  SELECT geo_code, 'linear' AS model, 10e0 AS x0, 1.01e0 AS x_1, 0e0 AS x_2, 0.5e0 AS x_3, 0.25e0 AS x_4 FROM (SELECT DISTINCT geo_code FROM matrix)
  UNION ALL SELECT geo_code, 'ridge', 20e0, 0.99e0, 0.01e0, 0.5e0, 0.25e0 FROM (SELECT DISTINCT geo_code FROM matrix) WHERE length(geo_code) = 2)"""


def _coefs(matrix):
    areas = matrix.select("geo_code").distinct()

    def model(name, intercept, coef):
        return F.struct(
            F.lit(name).alias("model"), F.array(*[F.lit(float(x)) for x in coef]).alias("coef"), F.lit(float(intercept)).alias("intercept"), F.lit(False).alias("use_delta")
        )

    one, two = model("linear", 10, [1.01, 0, 0.5, 0.25]), model("ridge", 20, [0.99, 0.01, 0.5, 0.25])
    both = F.when(F.length("geo_code") == 2, F.array(one, two)).otherwise(F.array(one))
    return areas.select("geo_code", F.inline(both))


CHOSEN_SQL = COEF_SQL + """,
chosen AS (SELECT * FROM coefs QUALIFY row_number() OVER (PARTITION BY geo_code ORDER BY model = 'linear') = 1)"""
SURVEY_SQL = "SELECT geo_code, year, indicator_code AS code, value AS actual FROM fx_ind WHERE indicator_code LIKE 'ACS%' AND year BETWEEN 2000 AND 2004"
FEATURE_SQL = """SELECT geo_code, year, 'BLS_UNRATE', unemployment_rate FROM matrix WHERE year BETWEEN 2000 AND 2004
  UNION ALL SELECT geo_code, year, 'CPI_SHELTER', rent_cpi_index FROM matrix WHERE year BETWEEN 2000 AND 2004"""


@query("features_actual", f"{SURVEY_SQL} UNION ALL {FEATURE_SQL}")
def features_actual(spark, d):
    return serve.compared_actuals(b.indicators(spark, d), b.matrix(spark, d), 2000, END)


@query(
    "features_compare",
    f"""SELECT a.geo_code, c.code, CAST(y.year AS INTEGER) AS year, k.actual, CASE c.code WHEN 'POPULATION_IMPLIED' THEN {r('p.projected', 0)} WHEN 'CPI_SHELTER' THEN {r('p.projected', 4)} ELSE {r('p.projected', 9)} END AS projected
        FROM (SELECT DISTINCT geo_code FROM (SELECT geo_code FROM known UNION ALL SELECT geo_code FROM roll)) a
        CROSS JOIN (VALUES ('ACS1_TOTAL_POP'), ('ACS5_TOTAL_POP'), ('BLS_UNRATE'), ('CPI_SHELTER'), ('POPULATION_IMPLIED')) AS c(code)
        CROSS JOIN (SELECT unnest(range(2000, 2005)) AS year) y
        LEFT JOIN known k ON k.geo_code = a.geo_code AND k.code = c.code AND k.year = y.year
        LEFT JOIN (SELECT geo_code, year, 'BLS_UNRATE' AS code, unemployment_rate AS projected FROM roll
                   UNION ALL SELECT geo_code, year, 'CPI_SHELTER', rent_cpi_index FROM roll
                   UNION ALL SELECT geo_code, year, 'POPULATION_IMPLIED', yhat FROM roll) p
          ON p.geo_code = a.geo_code AND p.code = c.code AND p.year = y.year""",
    ",\n" + CHOSEN_SQL + f",\nknown AS ({SURVEY_SQL} UNION ALL {FEATURE_SQL}),\n"
    + roll_sql("roll", "(SELECT * FROM matrix WHERE year BETWEEN 2000 AND 2004)", "chosen", "geo_code", "year", "2004"),
)
def features_compare(spark, d):
    """Asks for a model nobody has, so each area falls back to one it has."""
    matrix = stored(b.matrix(spark, d), "matrix")
    rows = serve.features_compare(
        b.indicators(spark, d), matrix, _coefs(matrix), REGRESSORS, 2000, END, model="missing"
    )
    digits = F.when(F.col("code") == serve.IMPLIED_CODE, F.round("projected", 0)).when(
        F.col("code") == codes.SHELTER_PRICES, F.round("projected", 4)
    )
    return rows.withColumn("projected", digits.otherwise(F.round("projected", 9)))


PREDICT_SQL = """SELECT geo_code, year, model, x0 + x_1 * pop_lag1 + x_2 * pop_lag5 + x_3 * unemployment_rate + x_4 * rent_cpi_index AS yhat
  FROM matrix JOIN coefs USING (geo_code) WHERE year BETWEEN 2000 AND 2004"""


def _rolls(history):
    parts = [
        roll_sql(f"roll_{m}", history, f"(SELECT * FROM coefs WHERE model = '{m}')", "geo_code", "year", "2004") for m in ("linear", "ridge")
    ]
    return ",\n".join(parts)


#: Small trees of each area, which SQL can grow too.
ROUNDS, RATE = 3, 0.5
STUMPS = dict(rounds=ROUNDS, depth=1, rate=RATE, row_share=1, feature_share=1)
STUMP_LEVEL = stump_score("[coalesce(l1, 0.0), coalesce(l5, 0.0), u2, c2]", ROUNDS)
STUMP_KNOWN = stump_score(f"[{', '.join(REGRESSORS)}]", ROUNDS)


def _stump_ctes(source, roll, history, until):
    grown = stump_sql("stump", source, "geo_code", REGRESSORS, ROUNDS, RATE)
    return grown + ",\n" + roll_sql(roll, history, "stump", "geo_code", "year", until, ["x0", *stump_columns(ROUNDS)], STUMP_LEVEL)


def _stored(spark, *models):
    path = fresh_dir(spark, "models")
    for coefs in models:
        save_models(coefs, path, "geo_code")
    return load_models(spark, path)


@query(
    "export_bundle",
    f"""SELECT p.geo_code, p.year, p.model, {r('p.yhat', 0, 'predicted')}, CAST(population AS DOUBLE) AS actual
        FROM ({PREDICT_SQL} UNION ALL SELECT geo_code, year, 'linear', yhat FROM roll_linear UNION ALL SELECT geo_code, year, 'ridge', yhat FROM roll_ridge
              UNION ALL SELECT geo_code, year, 'xgb', {STUMP_KNOWN} FROM matrix JOIN stump USING (geo_code) WHERE year BETWEEN 2000 AND 2004
              UNION ALL SELECT geo_code, year, 'xgb', yhat FROM roll_xgb) p
        LEFT JOIN fx_pop f ON f.geo_code = p.geo_code AND f.year = p.year""",
    ",\n" + COEF_SQL + ",\n" + _rolls("(SELECT * FROM matrix WHERE year BETWEEN 2000 AND 2004)")
    + ",\n" + _stump_ctes("matrix", "roll_xgb", "(SELECT * FROM matrix WHERE year BETWEEN 2000 AND 2004)", "2004"),
)
def export_bundle(spark, d):
    """The predictions of an export, read back from its files; trees come from the model store."""
    root = fresh_dir(spark, "export")
    matrix, people = stored(b.matrix(spark, d), "matrix"), stored(b.population(spark, d), "population")
    trees = _stored(spark, fit_trees(matrix, "geo_code", "year", REGRESSORS, "population", **STUMPS))
    lines = _coefs(matrix).withColumn("features", F.array(*map(F.lit, REGRESSORS)))
    models = trees.select("geo_code", "model", "features", "coef", "intercept", "use_delta", "trees").unionByName(lines, allowMissingColumns=True)
    write_bundle(root, b.indicators(spark, d), matrix, people, models, REGRESSORS, 2000, END)
    schema = "geo_code string, year int, predicted double, actual double, model string"
    rows = spark.read.schema(schema).option("header", True).csv(f"{root}/predictions")
    return rounded(rows, predicted=0)


@query(
    "best_model_series",
    f"""SELECT g.geo_code, CAST(y.year AS INTEGER) AS year, {r('p.yhat', 0, 'yhat')}, CAST(f.population AS DOUBLE) AS actual, g.model AS label
        FROM (SELECT geo_code, model FROM card WHERE rank_within_geo_code = 1) g
        CROSS JOIN (SELECT unnest(range(1999, 2005)) AS year) y
        LEFT JOIN fx_pop f ON f.geo_code = g.geo_code AND f.year = y.year
        LEFT JOIN (SELECT geo_code, year, x0 + x_1 * pop_lag1 + x_2 * pop_lag5 + x_3 * unemployment_rate + x_4 * rent_cpi_index AS yhat
                   FROM matrix JOIN coefs USING (geo_code) WHERE model = 'ridge'
                   UNION ALL SELECT geo_code, year, yhat FROM roll) p ON p.geo_code = g.geo_code AND p.year = y.year
        WHERE g.geo_code IN (SELECT geo_code FROM fx_pop WHERE year BETWEEN 1999 AND 2004)""",
    ",\n" + COEF_SQL + ",\n"
    + roll_sql("roll", "(SELECT * FROM matrix WHERE year BETWEEN 1999 AND 2004)", "(SELECT * FROM coefs WHERE model = 'ridge')", "geo_code", "year", "2004"),
)
def best_model_series(spark, d):
    """Each area's best run decides the label; all labels share one set of coefficients."""
    card = scorecard(b.runs(spark, d), b.metrics(spark, d))
    names = F.explode(F.array(*[F.lit(m) for m in b.RUN_MODELS]))
    matrix = stored(b.matrix(spark, d), "matrix")
    coefs = _coefs(matrix).filter(F.col("model") == "ridge").withColumn("model", names)
    people = b.population(spark, d).filter(F.length("geo_code") == 2)
    rows = serve.best_model_series(card, coefs, matrix, people, REGRESSORS, 1999, END)
    return rounded(rows, yhat=0)


STATE, COUNTY = "length(geo_code) = 2", "length(geo_code) <> 2"
LONG = "(SELECT * FROM matrix WHERE year BETWEEN 2000 AND 2007)"


@query(
    "predict_by_model",
    f"""SELECT geo_code, year, {r('yhat', 0, 'yhat')}, kind FROM (
          SELECT geo_code, year, {STUMP_KNOWN} AS yhat, 'covered' AS kind FROM {LONG} JOIN stump USING (geo_code)
          UNION ALL SELECT geo_code, year, yhat, 'future' FROM roll_xgb
          UNION ALL SELECT geo_code, year, {score_sql(REGRESSORS[:1])}, 'covered' FROM {LONG} JOIN line USING (geo_code)
          UNION ALL SELECT geo_code, year, yhat, 'future' FROM roll_line)""",
    ",\n" + _stump_ctes(f"(SELECT * FROM matrix WHERE {STATE})", "roll_xgb", LONG, "2007")
    + ",\n" + fit_sql("line", f"(SELECT * FROM matrix WHERE {COUNTY})", "geo_code", REGRESSORS[:1], alpha=1.0)
    + ",\n" + roll_sql("roll_line", LONG, "(SELECT *, 0 AS x_2, 0 AS x_3, 0 AS x_4 FROM line)", "geo_code", "year", "2007"),
)
def predict_by_model(spark, d):
    """Stored trees of the states and stored lines of the counties, each scored and rolled forward."""
    matrix = stored(b.matrix(spark, d), "matrix")
    state = F.length("geo_code") == 2
    trees = fit_trees(matrix.filter(state), "geo_code", "year", REGRESSORS, "population", **STUMPS)
    line = fit_linear(matrix.filter(~state), "geo_code", REGRESSORS[:1], "population", alpha=1.0)
    models = _stored(spark, trees, line)
    parts = [
        serve.predict_by_model(matrix, models.filter(F.col("model") == name), features, 2000, END + 3)
        for name, features in (("xgb", REGRESSORS), ("ridge", REGRESSORS[:1]))
    ]
    return rounded(parts[0].unionByName(parts[1]), yhat=0)


@query(
    "tree_nodes",
    """SELECT geo_code, CAST(k - 1 AS INTEGER) AS tree, CAST(node AS INTEGER) AS node,
              CASE WHEN node = 0 AND f IS NOT NULL THEN ['pop_lag1', 'pop_lag5', 'unemployment_rate', 'rent_cpi_index'][f] END AS feature,
              CASE WHEN node = 0 AND f IS NOT NULL THEN 1 END AS "left", CASE WHEN node = 0 AND f IS NOT NULL THEN 2 END AS "right",
              """ + r("CASE WHEN node = 2 THEN b WHEN node = 1 OR f IS NULL THEN a END", 0, "leaf") + f"""
       FROM (SELECT geo_code, unnest(range(1, {ROUNDS + 1})) AS k, unnest([{', '.join(f'f_{k}' for k in range(1, ROUNDS + 1))}]) AS f,
                    unnest([{', '.join(f'a_{k}' for k in range(1, ROUNDS + 1))}]) AS a, unnest([{', '.join(f'b_{k}' for k in range(1, ROUNDS + 1))}]) AS b FROM stump),
            (SELECT unnest(range(0, 3)) AS node) s
       WHERE node = 0 OR f IS NOT NULL""",
    ",\n" + stump_sql("stump", "matrix", "geo_code", REGRESSORS, ROUNDS, RATE),
)
def tree_nodes_(spark, d):
    """The nodes of every area's stored trees."""
    trees = _stored(spark, fit_trees(b.matrix(spark, d), "geo_code", "year", REGRESSORS, "population", **STUMPS))
    return rounded(tree_nodes(trees, "geo_code").drop("threshold"), leaf=0)


@query("boosted_areas")
def boosted_areas(spark, d):
    """The trees of every area and month at full size, stored and then served."""
    rows = stored(b.month_features(spark, d), "months").withColumnsRenamed({"entity": "geo_code", "period": "year"})
    trees = fit_trees(rows.filter(F.col("year") <= 24000), "geo_code", "year", REGRESSORS, "population")
    scored = predict_known(rows, _stored(spark, trees), "geo_code", "year", REGRESSORS)
    return scored.join(rows.select("geo_code", "year", "population"), ["geo_code", "year"])
