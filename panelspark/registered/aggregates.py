"""Aggregations and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions.guarded import number_or_null
from ..operators import annual as a
from ..operators import hashtree as h
from ..operators import panel as p
from ..operators import quality as q
from ..operators.metrics import as_metric_rows, forecast_metrics as v1_metrics, regression_metrics as v2_metrics
from ..operators.registry import model_headline as headline, qualifying_entities as qualifying
from .base import query, r, rounded


@query(
    "annual_mean",
    f"SELECT series_id, CAST(year(obs_date) AS INTEGER) AS year, {r('avg(TRY_CAST(nullif(raw_value, chr(46)) AS DOUBLE))', 4, 'value')} FROM obs GROUP BY 1, 2",
)
def annual_mean(spark, d):
    rows = b.price_observations(spark, d).withColumn("number", number_or_null(F.col("raw_value")))
    return rounded(a.annual_mean(rows, "series_id", "obs_date", "number"), value=4)


@query("annual_preferred", f"SELECT series_id, year, {r('value', 4, 'value')} FROM annual")
def annual_preferred(spark, d):
    return rounded(a.annual_preferred(b.monthly_points(spark, d)), value=4)


@query(
    "stage_rollup",
    f"SELECT geo_code, year, min(geo_type) AS geo_type, {r('avg(CAST(population AS DOUBLE))', 2, 'unrate')} FROM fx_survey GROUP BY 1, 2",
)
def stage_rollup(spark, d):
    rows = b.survey_rows(spark, d).withColumn("unrate", F.col("population").cast("double"))
    return rounded(a.stage_rollup(rows), unrate=2)


@query("model_headline", "SELECT run_id, r2_test, rmse_test, mae_test FROM headline")
def model_headline(spark, d):
    return headline(b.metrics(spark, d))


@query("first_full_period", "SELECT geo_code, first_full_year FROM cutins")
def first_full_period(spark, d):
    return p.first_full_period(b.joined(spark, d), "geo_code", "year", "has_full_features", "first_full_year")


@query("qualifying_entities", "SELECT geo_code, count(*) AS years FROM matrix WHERE has_full_features GROUP BY 1 HAVING count(*) >= 2")
def qualifying_entities(spark, d):
    return qualifying(b.matrix(spark, d), 2)


@query(
    "duplicate_keys",
    "SELECT c_nationkey, yr AS year, mon AS month, count(*) AS dup_count FROM oc GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def duplicate_keys(spark, d):
    return q.duplicate_keys(b.placed_orders(spark, d), ["c_nationkey", "year", "month"])


@query("feature_matrix_unique", "SELECT geo_code, year, count(*) AS dup_count FROM matrix GROUP BY 1, 2 HAVING count(*) > 1")
def feature_matrix_unique(spark, d):
    return q.duplicate_keys(b.matrix(spark, d), ["geo_code", "year"])


@query(
    "row_counts",
    """SELECT 'geography' AS "table", count(*) AS rows FROM fx_geo UNION ALL SELECT 'population', count(*) FROM fx_pop
       UNION ALL SELECT 'indicators', count(*) FROM fx_ind UNION ALL SELECT 'feature_matrix', count(*) FROM matrix""",
)
def row_counts(spark, d):
    return q.row_counts(
        {
            "geography": b.geography(spark, d),
            "population": b.population(spark, d),
            "indicators": b.indicators(spark, d),
            "feature_matrix": b.matrix(spark, d),
        }
    )


@query(
    "row_parity",
    """SELECT (SELECT count(*) FROM matrix) AS fm_rows, (SELECT count(*) FROM fx_pop) AS population_rows,
              (SELECT count(*) FROM fx_pop) - (SELECT count(*) FROM matrix) AS gap""",
)
def row_parity(spark, d):
    return q.row_parity(b.matrix(spark, d), b.population(spark, d), "fm_rows", "population_rows")


@query("coverage_span", "SELECT indicator_code, min(year) AS min_year, max(year) AS max_year, count(*) AS rows FROM fx_ind GROUP BY 1")
def coverage_span(spark, d):
    return q.period_span(b.indicators(spark, d), "year", ["indicator_code"])


@query("population_span", "SELECT min(year) AS min_year, max(year) AS max_year, count(*) AS rows FROM fx_pop")
def population_span(spark, d):
    return q.period_span(b.population(spark, d), "year")


@query(
    "rows_per_period_code",
    "SELECT year, indicator_code, count(*) AS rows FROM fx_ind WHERE indicator_code IN ('ACS1_TOTAL_POP', 'ACS5_TOTAL_POP', 'BLS_UNRATE') GROUP BY 1, 2",
)
def rows_per_period_code(spark, d):
    chosen = F.col("indicator_code").isin("ACS1_TOTAL_POP", "ACS5_TOTAL_POP", "BLS_UNRATE")
    return q.count_by(b.indicators(spark, d).filter(chosen), ["year", "indicator_code"])


@query(
    "bad_value_counts",
    """SELECT indicator_code, count(*) FILTER (WHERE value IS NULL OR value <= 0) AS not_positive,
         count(*) FILTER (WHERE value IS NULL OR value < 0 OR value > 50) AS out_of_range, min(value) AS min_value, max(value) AS max_value
       FROM fx_ind GROUP BY 1""",
)
def bad_value_counts(spark, d):
    value = F.col("value")
    return b.indicators(spark, d).groupBy("indicator_code").agg(
        F.count_if(value.isNull() | (value <= 0)).alias("not_positive"),
        F.count_if(value.isNull() | (value < 0) | (value > 50)).alias("out_of_range"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


@query(
    "nonnull_coverage",
    "SELECT year, count(*) AS rows, count(unemployment_rate) AS unrate_nonnull, count(own_index) AS cpi_shelter_nonnull FROM joined GROUP BY 1",
)
def nonnull_coverage(spark, d):
    return q.known_by_period(
        b.joined(spark, d), "year", {"unemployment_rate": "unrate_nonnull", "own_index": "cpi_shelter_nonnull"}
    )


@query("distinct_array", "SELECT string_agg(DISTINCT geo_code, ',' ORDER BY geo_code) AS distinct_geos FROM fx_cpi")
def distinct_array(spark, d):
    values = q.distinct_values(b.shelter_prices(spark, d), "geo_code", "distinct_geos")
    return values.select(F.array_join("distinct_geos", ",").alias("distinct_geos"))


@query("source_unit_census", "SELECT source, unit, count(*) AS rows FROM fx_ind GROUP BY 1, 2")
def source_unit_census(spark, d):
    return q.count_by(b.indicators(spark, d), ["source", "unit"])


@query("freshness", "SELECT indicator_code, max(year) AS latest_year, count(*) AS total_rows FROM fx_ind GROUP BY 1")
def freshness(spark, d):
    return q.freshness(b.indicators(spark, d))


@query(
    "validation_report",
    """SELECT 'acs' AS source, count(*) AS rows, count(DISTINCT geo_code) AS geos, min(year) AS year_min, max(year) AS year_max,
         CASE WHEN count(*) = 0 THEN 'no rows' WHEN min(CASE WHEN year = 1998 THEN -population ELSE population END) < 0 THEN 'negative population' ELSE '' END AS issues
       FROM fx_survey""",
)
def validation_report(spark, d):
    rows = b.survey_rows(spark, d).withColumn(
        "population", F.when(F.col("year") == 1998, -F.col("population")).otherwise(F.col("population"))
    )
    report = q.validation_report(rows, "acs", "population", "population", "geo_code")
    return report.withColumn("issues", F.array_join("issues", "; "))


def _predicted(spark, d):
    """Each month predicted by the one before."""
    return b.month_features(spark, d).select(
        "entity", "period", F.col("population").alias("actual"), F.col("pop_lag1").alias("yhat")
    )


R2_SQL = "1.0 - sum(pow(pop_lag1 - population, 2)) / nullif(var_pop(population) * count(*), 0)"
METRICS_SQL = f"""SELECT entity, {r('avg(abs(pop_lag1 - population))', 0, 'mae')}, {r('sqrt(avg(pow(pop_lag1 - population, 2)))', 0, 'rmse')},
  {r(R2_SQL, 6, 'r2')}, {r('avg(abs(pop_lag1 - population) / abs(population)) * 100', 6, 'mape')} FROM mfeat GROUP BY 1 HAVING count(*) > 1"""


@query("forecast_metrics", METRICS_SQL)
def forecast_metrics(spark, d):
    rows = v1_metrics(_predicted(spark, d), ["entity"]).filter(F.col("r2").isNotNull())
    return rounded(rows, mae=0, rmse=0, r2=6, mape=6)


@query(
    "metric_rows",
    f"""SELECT entity, metric, 'test' AS scope, -1 AS fold, value FROM (
          SELECT entity, {r('avg(abs(pop_lag1 - population))', 0, 'mae')}, {r('avg(abs(pop_lag1 - population) / abs(population)) * 100', 6, 'mape')}
          FROM mfeat GROUP BY 1) UNPIVOT (value FOR metric IN (mae, mape))""",
)
def metric_rows(spark, d):
    wide = rounded(v1_metrics(_predicted(spark, d), ["entity"]), mae=0, mape=6).select("entity", "mae", "mape")
    return as_metric_rows(wide, ["entity"], "test")


@query(
    "regression_metrics",
    METRICS_SQL.replace("FROM mfeat", f", {r('avg(pow(pop_lag1 - population, 2)) / 1e6', 2, 'mse')} FROM mfeat"),
)
def regression_metrics(spark, d):
    rows = v2_metrics(_predicted(spark, d), ["entity"]).filter(F.col("r2").isNotNull())
    rows = rows.withColumn("mse", F.col("mse") / 1e6)
    return rounded(rows, mae=0, rmse=0, r2=6, mape=6, mse=2)


@query(
    "recent_stats",
    f"""SELECT entity, count(*) AS n_values,
          {r('coalesce(pow(max_by(value, period) / min_by(value, period), 1.0 / nullif(count(*) - 1, 0)) - 1, 0)', 8, 'cagr')},
          {r('coalesce(avg(step), 0)', 0, 'step_mean')}, {r('coalesce(stddev_pop(step), 0)', 0, 'step_std')}
        FROM (SELECT *, value - lag(value) OVER (PARTITION BY entity ORDER BY period) AS step FROM (
                SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS age FROM mpanel) WHERE age <= 6)
        GROUP BY 1""",
)
def recent_stats(spark, d):
    stats = p.recent_stats(b.month_panel(spark, d), "entity", "period", "value", 5)
    return rounded(stats, cagr=8, step_mean=0, step_std=0)


@query(
    "entity_fingerprint",
    """SELECT geo_code, md5(string_agg(CAST(year AS VARCHAR) || '|' || CAST(CAST(population AS BIGINT) AS VARCHAR) || '|' ||
         coalesce(CAST(CAST(pop_lag1 AS BIGINT) AS VARCHAR), '__NA__') || '|' || coalesce(CAST(CAST(pop_lag5 AS BIGINT) AS VARCHAR), '__NA__')
         || '|' || coalesce(CAST(CAST(unemployment_rate AS DECIMAL(38,6)) AS VARCHAR), '__NA__'),
         chr(10) ORDER BY year)) AS data_hash FROM joined GROUP BY 1""",
)
def entity_fingerprint(spark, d):
    rows = b.joined(spark, d).withColumns({c: F.col(c).cast("bigint") for c in ["population", "pop_lag1", "pop_lag5"]})
    return p.fingerprint(rows, "geo_code", "year", ["year", "population", "pop_lag1", "pop_lag5", "unemployment_rate"])


TREE_COLUMNS = ["year", "population", "pop_lag1", "unemployment_rate"]
LEAF_LINES = """CAST(year AS VARCHAR) || '|' || CAST(CAST(population AS BIGINT) AS VARCHAR) || '|' ||
  coalesce(CAST(CAST(pop_lag1 AS BIGINT) AS VARCHAR), '__NA__') || '|' ||
  coalesce(CAST(CAST({rate} AS DECIMAL(38,6)) AS VARCHAR), '__NA__')"""
LEAVES_SQL = """SELECT geo_code, CAST(floor(year / 2.0) * 2 AS INTEGER) AS block, md5(string_agg(%s, chr(10) ORDER BY year)) AS leaf,
  count(*) AS rows, count(pop_lag1) AS full_rows FROM joined%s GROUP BY ALL"""
RATE_BEFORE = "CASE WHEN year = 1996 AND geo_code LIKE '%3' THEN unemployment_rate + 1 ELSE unemployment_rate END"
BLOCKS_SQL = (
    ", live AS (" + LEAVES_SQL % (LEAF_LINES.format(rate="unemployment_rate"), " WHERE year <> 1994 OR geo_code NOT LIKE '%5'")
    + "), known AS (" + LEAVES_SQL % (LEAF_LINES.format(rate=RATE_BEFORE), " WHERE year < 1998") + ")"
)


def _leaves(rows, rate="unemployment_rate"):
    whole = rows.withColumns({c: F.col(c).cast("bigint") for c in ["population", "pop_lag1"]}).withColumn("unemployment_rate", F.expr(rate))
    return h.leaf_hashes(whole, "geo_code", "year", TREE_COLUMNS, span=2, full=F.col("pop_lag1").isNotNull())


@query(
    "fingerprint_tree",
    """SELECT geo_code, md5(string_agg(block || ':' || leaf, chr(10) ORDER BY block)) AS data_hash,
       CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(full_rows) AS BIGINT) AS full_rows FROM leaves GROUP BY 1""",
    ", leaves AS (" + LEAVES_SQL % (LEAF_LINES.format(rate="unemployment_rate"), "") + ")",
)
def fingerprint_tree(spark, d):
    return h.root_hashes(_leaves(b.joined(spark, d)), "geo_code")


@query(
    "drifted_blocks",
    """SELECT coalesce(l.geo_code, k.geo_code) AS geo_code, coalesce(l.block, k.block) AS block,
       CASE WHEN k.leaf IS NULL THEN 'added' WHEN l.leaf IS NULL THEN 'removed' ELSE 'changed' END AS drift
       FROM live l FULL JOIN known k ON l.geo_code = k.geo_code AND l.block = k.block WHERE l.leaf IS DISTINCT FROM k.leaf""",
    BLOCKS_SQL,
)
def drifted_blocks(spark, d):
    """Blocks that differ from an earlier state: years that came, years that went, and a revised rate."""
    rows = b.joined(spark, d)
    live = _leaves(rows.filter("year <> 1994 OR geo_code NOT LIKE '%5'"))
    return h.drifted_blocks(live, _leaves(rows.filter("year < 1998"), RATE_BEFORE), "geo_code")


@query(
    "extract_profile",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE geo_type = 'state') AS states, count(*) FILTER (WHERE geo_type = 'county') AS counties,
              count(DISTINCT geo_code) AS areas FROM fx_survey""",
)
def extract_profile(spark, d):
    return a.extract_profile(b.survey_rows(spark, d))


@query("series_prefixes", "SELECT substr(series_id, 1, 5) AS prefix, count(DISTINCT series_id) AS series FROM mpoints GROUP BY 1")
def series_prefixes(spark, d):
    return b.monthly_points(spark, d).groupBy(F.substring("series_id", 1, 5).alias("prefix")).agg(
        F.countDistinct("series_id").alias("series")
    )


@query(
    "rule_violations",
    """SELECT 'population_not_negative' AS rule, count(*) FILTER (WHERE NOT (population - 1000000 >= 0)) AS violations FROM fx_pop
       UNION ALL SELECT 'year_in_calendar', count(*) FILTER (WHERE NOT (year + 100 BETWEEN 1900 AND 2100)) FROM fx_pop
       UNION ALL SELECT 'rate_is_percent', count(*) FILTER (WHERE NOT (value * 20 BETWEEN 0 AND 100)) FROM fx_rate
       UNION ALL SELECT 'index_not_negative', count(*) FILTER (WHERE NOT (value - 250 >= 0)) FROM fx_cpi""",
)
def rule_violations(spark, d):
    """Rows shifted so that every rule is broken by some of them."""
    people = b.population(spark, d).withColumns({"population": F.col("population") - 1_000_000, "year": F.col("year") + 100})
    rates = b.unemployment(spark, d).withColumn("value", F.col("value") * 20)
    prices = b.shelter_prices(spark, d).withColumn("value", F.col("value") - 250)
    return (
        q.rule_violations(people, q.POPULATION_RULES)
        .unionByName(q.rule_violations(rates, q.RATE_RULES))
        .unionByName(q.rule_violations(prices, q.INDEX_RULES))
    )


@query("null_keys", "SELECT count(*) FILTER (WHERE status IS NULL) AS status_nulls, count(*) FILTER (WHERE key IS NULL) AS key_nulls FROM fx_rows")
def null_keys(spark, d):
    return q.null_keys(b.order_rows(spark, d), ["status", "key"])
