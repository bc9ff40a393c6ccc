"""Projections, filters and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import codes
from ..functions.guarded import (
    all_present,
    compound_growth_pct,
    growth_pct,
    integer_or_null,
    number_or_null,
    year_end,
    year_start,
)
from ..operators import panel as p
from ..operators.forecast import predict_known
from ..operators.regression import fit_linear
from ..operators.ranking import chunked
from ..plans import serve
from ..plans.features import FEATURE_COLUMNS, NOT_REGRESSORS, REGRESSORS
from .base import query, r, rounded

MATRIX_DIGITS = {
    "pop_ma3": 4,
    "pop_yoy_growth_pct": 6,
    "pop_cagr_5yr_pct": 6,
}
MATRIX_SQL = f"""geo_code, year, population, pop_lag1, pop_lag5, {r('pop_ma3', 4, 'pop_ma3')},
  {r('pop_yoy_growth_pct', 6, 'pop_yoy_growth_pct')}, {r('pop_cagr_5yr_pct', 6, 'pop_cagr_5yr_pct')},
  unemployment_rate, rent_cpi_index"""


@query("feature_matrix", f"SELECT {MATRIX_SQL}, has_full_features FROM matrix")
def feature_matrix(spark, d):
    return rounded(b.matrix(spark, d), **MATRIX_DIGITS)


@query("scan_entity", f"SELECT {MATRIX_SQL} FROM matrix WHERE geo_code = '01' ORDER BY year")
def scan_entity(spark, d):
    rows = b.matrix(spark, d).filter(F.col("geo_code") == "01").orderBy("year").drop("has_full_features")
    return rounded(rows, **MATRIX_DIGITS)


@query("window_slice", f"SELECT {MATRIX_SQL} FROM matrix WHERE geo_code IN ('US', '02') AND year BETWEEN 2000 AND 2001")
def window_slice(spark, d):
    return rounded(serve.window_slice(b.matrix(spark, d), 2000, 2001, ["US", "02"]).drop("has_full_features"), **MATRIX_DIGITS)


@query("actuals", "SELECT geo_code, year, CAST(population AS DOUBLE) AS population FROM fx_pop WHERE year BETWEEN 1996 AND 2000")
def actuals(spark, d):
    return serve.actuals(b.population(spark, d), 1996, 2000)


@query("series", "SELECT geo_code, year, indicator_code, value FROM fx_ind WHERE indicator_code = 'BLS_UNRATE' AND year BETWEEN 1996 AND 2000")
def series(spark, d):
    return serve.series(b.indicators(spark, d), [codes.UNEMPLOYMENT], 1996, 2000)


@query(
    "series_in_list",
    "SELECT geo_code, year, indicator_code, value FROM fx_ind WHERE indicator_code IN ('ACS1_TOTAL_POP', 'ACS5_TOTAL_POP') AND year BETWEEN 1995 AND 2001",
)
def series_in_list(spark, d):
    return serve.series(b.indicators(spark, d), serve.COMPARED_SURVEYS, 1995, 2001)


@query("indicator_slice", "SELECT geo_code, year, indicator_code, value, source, unit FROM fx_ind WHERE year BETWEEN 1997 AND 1999")
def indicator_slice(spark, d):
    return serve.indicator_slice(b.indicators(spark, d), 1997, 1999)


@query("regex_class", "SELECT geo_code, geo_type FROM fx_geo WHERE regexp_full_match(geo_code, '\\d{2}') OR regexp_full_match(geo_code, '\\d{5}')")
def regex_class(spark, d):
    return b.geography(spark, d).filter(codes.is_state_or_county(F.col("geo_code"))).select("geo_code", "geo_type")


@query(
    "region_map",
    """SELECT f.geo_code, f.year, g.region FROM fx_pop f LEFT JOIN fx_region g ON g.prefix = substr(f.geo_code, 1, 2)""",
)
def region_map(spark, d):
    from ..plans.features import with_region

    return with_region(b.population(spark, d), b.regions(spark, d)).select("geo_code", "year", "region")


@query(
    "region_map_census",
    "SELECT geo_code, region FROM fx_geo LEFT JOIN listed ON regexp_full_match(geo_code, prefix || '([0-9]{3})?')",
    ",\nlisted(prefix, region) AS (VALUES " + ", ".join(f"('{s}', '{k}')" for k, states in codes.REGION_STATES.items() for s in states) + ")",
)
def region_map_census(spark, d):
    return b.geography(spark, d).select("geo_code", codes.region_of(F.col("geo_code")).alias("region"))


@query("yoy_growth", f"SELECT geo_code, year, {r('pop_yoy_growth_pct', 6, 'growth')} FROM joined")
def yoy_growth(spark, d):
    lagged = p.with_lags(b.population(spark, d), "geo_code", "year", "population", {1: "base"})
    return rounded(lagged.select("geo_code", "year", growth_pct(F.col("population"), F.col("base")).alias("growth")), growth=6)


@query("cagr_n", f"SELECT geo_code, year, {r('pop_cagr_5yr_pct', 6, 'growth')} FROM joined")
def cagr_n(spark, d):
    lagged = p.with_lags(b.population(spark, d), "geo_code", "year", "population", {5: "base"})
    value = compound_growth_pct(F.col("population"), F.col("base"), 5)
    return rounded(lagged.select("geo_code", "year", value.alias("growth")), growth=6)


@query("completeness_flag", "SELECT geo_code, year, has_full_features FROM flagged")
def completeness_flag(spark, d):
    return b.joined(spark, d).select("geo_code", "year", all_present(FEATURE_COLUMNS).alias("has_full_features"))


@query("fallback_coalesce", "SELECT geo_code, year, own_index, region_index, nation_index, rent_cpi_index FROM joined")
def fallback_coalesce(spark, d):
    return b.joined(spark, d).select("geo_code", "year", "own_index", "region_index", "nation_index", "rent_cpi_index")


SERIES_ID_SQL = """CASE WHEN length(geo_code) = 5 THEN 'LAUCN' || geo_code || '0000000003'
   WHEN regexp_full_match(geo_code, '\\d{2}') THEN 'LASST' || geo_code || '0000000000003' END"""


@query("series_encode", f"SELECT geo_code, {SERIES_ID_SQL} AS series_id FROM fx_geo WHERE geo_type IN ('state', 'county')")
def series_encode(spark, d):
    rows = b.geography(spark, d).filter(F.col("geo_type").isin("state", "county"))
    return rows.select("geo_code", codes.series_id_for(F.col("geo_code")).alias("series_id"))


@query(
    "series_decode",
    """SELECT series_id, CASE WHEN series_id LIKE 'LASST%' THEN 'state' ELSE 'county' END AS geo_type,
         CASE WHEN series_id LIKE 'LASST%' THEN substr(series_id, 6, 2) ELSE substr(series_id, 6, 5) END AS geo_code
       FROM (SELECT CASE WHEN prefix = 'LASST' THEN 'LASST' || st || '0000000000003'
                         WHEN prefix = 'LAUCN' THEN 'LAUCN' || st || seg || '0000000003' ELSE 'XXXXX' || st END AS series_id
             FROM (SELECT DISTINCT st, seg FROM oc), (VALUES ('LASST'), ('LAUCN'), ('XXXXX')) AS v(prefix))
       WHERE series_id LIKE 'LASST%' OR series_id LIKE 'LAUCN%' GROUP BY ALL""",
)
def series_decode(spark, d):
    areas = b.placed_orders(spark, d).select("state", "segment").distinct()
    county = F.concat("state", "segment")
    ids = F.array(codes.series_id_for(F.col("state")), codes.series_id_for(county), F.concat(F.lit("XXXXX"), "state"))
    series = areas.select(F.explode(ids).alias("series_id")).distinct()
    kind, code = codes.series_area_type(F.col("series_id")), codes.series_area_code(F.col("series_id"))
    return series.select("series_id", kind.alias("geo_type"), code.alias("geo_code")).filter(F.col("geo_type").isNotNull())


@query(
    "chunk_ids",
    f"""SELECT chunk, string_agg(series_id, ',' ORDER BY series_id) AS ids, count(*) AS n
        FROM (SELECT {SERIES_ID_SQL} AS series_id,
                     CAST((row_number() OVER (ORDER BY {SERIES_ID_SQL}) - 1) // 50 AS INTEGER) AS chunk
              FROM fx_geo WHERE geo_type IN ('state', 'county')) GROUP BY chunk""",
)
def chunk_ids(spark, d):
    rows = b.geography(spark, d).filter(F.col("geo_type").isin("state", "county"))
    ids = rows.select(codes.series_id_for(F.col("geo_code")).alias("series_id"))
    numbered = chunked(ids, ["series_id"], codes.IDS_PER_REQUEST, "chunk")
    return numbered.groupBy("chunk").agg(
        F.array_join(F.sort_array(F.collect_list("series_id")), ",").alias("ids"), F.count("*").alias("n")
    )


@query(
    "safe_cast",
    "SELECT series_id, year, period, TRY_CAST(nullif(value, '.') AS DOUBLE) AS number, TRY_CAST(substr(period, 2) AS INTEGER) AS month FROM mpoints",
)
def safe_cast(spark, d):
    return b.monthly_points(spark, d).select(
        "series_id",
        "year",
        "period",
        number_or_null(F.col("value")).alias("number"),
        integer_or_null(F.expr("substring(period, 2)")).alias("month"),
    )


@query(
    "code_map",
    """SELECT DISTINCT series_id,
         CASE series_id WHEN 'CUUR0000SAH1' THEN 'US' WHEN 'CUUR0100SAH1' THEN 'R1' WHEN 'CUUR0200SAH1' THEN 'R2'
                        WHEN 'CUUR0300SAH1' THEN 'R3' WHEN 'CUUR0400SAH1' THEN 'R4' END AS geo_code,
         CASE series_id WHEN 'CUUR0000SAH1' THEN 'United States' WHEN 'CUUR0100SAH1' THEN 'Northeast'
                        WHEN 'CUUR0200SAH1' THEN 'Midwest' WHEN 'CUUR0300SAH1' THEN 'South' WHEN 'CUUR0400SAH1' THEN 'West' END AS geo_name,
         CASE WHEN series_id = 'CUUR0000SAH1' THEN 'nation' WHEN series_id LIKE 'CUUR%' THEN 'region' END AS geo_type
       FROM obs""",
)
def code_map(spark, d):
    series = b.price_observations(spark, d).select("series_id").distinct()
    code = codes.price_area_code(F.col("series_id"))
    return series.select(
        "series_id",
        code.alias("geo_code"),
        codes.price_area_name(F.col("series_id")).alias("geo_name"),
        F.when(code.isNotNull(), codes.price_area_type(code)).alias("geo_type"),
    )


@query("survey_code", "SELECT geo_code, year, source, source || '_TOTAL_POP' AS indicator_code FROM fx_survey")
def survey_code(spark, d):
    rows = b.survey_rows(spark, d)
    return rows.select("geo_code", "year", "source", codes.survey_indicator(F.col("source")).alias("indicator_code"))


@query("align_features", "SELECT geo_code, year, rent_cpi_index AS cpi, unemployment_rate, pop_lag5, pop_lag1 FROM matrix")
def align_features(spark, d):
    order = ["cpi", "unemployment_rate", "pop_lag5", "pop_lag1"]
    return p.align(b.matrix(spark, d), order, ["geo_code", "year"], {"rent_cpi_index": "cpi"})


@query("numeric_features", "SELECT geo_code, year, pop_lag1, pop_lag5, unemployment_rate, rent_cpi_index FROM matrix")
def numeric_features(spark, d):
    matrix = b.matrix(spark, d)
    return matrix.select("geo_code", "year", *p.numeric_columns(matrix, NOT_REGRESSORS))


@query(
    "sane_features",
    "SELECT geo_code, concat_ws(',', "
    + ", ".join(f"CASE WHEN count({c}) >= 3 THEN '{c}' END" for c in REGRESSORS)
    + ") AS features FROM joined GROUP BY 1",
)
def sane_features(spark, d):
    usable = p.usable_features(b.joined(spark, d), "geo_code", REGRESSORS)
    return usable.select("geo_code", F.array_join("features", ",").alias("features"))


@query(
    "median_impute",
    f"""SELECT geo_code, year, population, pop_lag1,
          {r("coalesce(pop_lag5, median(pop_lag5) OVER (PARTITION BY geo_code))", 4, "pop_lag5")},
          {r("coalesce(unemployment_rate, median(unemployment_rate) OVER (PARTITION BY geo_code))", 4, "unemployment_rate")}
        FROM joined WHERE pop_lag1 IS NOT NULL OR geo_code NOT IN (SELECT geo_code FROM joined WHERE pop_lag1 IS NOT NULL)""",
)
def median_impute(spark, d):
    frame = p.training_frame(b.joined(spark, d), "geo_code", ["pop_lag1", "pop_lag5", "unemployment_rate"], "population")
    rows = frame.select("geo_code", "year", "population", "pop_lag1", "pop_lag5", "unemployment_rate")
    return rounded(rows, pop_lag5=4, unemployment_rate=4)


@query(
    "fill_zero",
    "SELECT geo_code, year, coalesce(pop_lag1, 0.0) AS pop_lag1, coalesce(pop_lag5, 0.0) AS pop_lag5, coalesce(unemployment_rate, 0.0) AS unemployment_rate FROM joined",
)
def fill_zero(spark, d):
    cols = ["pop_lag1", "pop_lag5", "unemployment_rate"]
    return p.fill_zero(b.joined(spark, d).select("geo_code", "year", *cols), cols)


DENSE_SQL = """dense AS (
  SELECT e.entity, CAST(s.p AS INTEGER) AS period, m.value
  FROM (SELECT DISTINCT entity FROM mpanel) e CROSS JOIN (SELECT unnest(range(23940, 24025)) AS p) s
  LEFT JOIN mpanel m ON m.entity = e.entity AND m.period = s.p)"""


@query("densify", "SELECT entity, period, value FROM dense", ",\n" + DENSE_SQL)
def densify(spark, d):
    return p.densify(b.month_panel(spark, d), "entity", "period", 23940, 24024)


@query(
    "ffill_bfill",
    """SELECT entity, period, coalesce(
         last_value(value IGNORE NULLS) OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(value IGNORE NULLS) OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
       FROM dense""",
    ",\n" + DENSE_SQL,
)
def ffill_bfill(spark, d):
    dense = p.densify(b.month_panel(spark, d), "entity", "period", 23940, 24024)
    return p.fill_neighbours(dense, "entity", "period", ["value"])


@query(
    "mean_fill",
    f"SELECT entity, period, {r('coalesce(value, avg(value) OVER (PARTITION BY entity))', 0, 'value')} FROM dense",
    ",\n" + DENSE_SQL,
)
def mean_fill(spark, d):
    dense = p.densify(b.month_panel(spark, d), "entity", "period", 23940, 24024)
    return rounded(p.fill_mean(dense, "entity", ["value"]), value=0)


@query(
    "effective_entity",
    """SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 3 = 0 THEN st || seg ELSE '' END, ''),
              nullif(CASE WHEN o_orderkey % 2 = 0 THEN st END, ''), 'US') AS geo_code FROM oc""",
)
def effective_entity(spark, d):
    key, state = F.col("o_orderkey"), F.col("state")
    county = F.when(key % 3 == 0, F.concat("state", "segment")).otherwise(F.lit(""))
    chosen = codes.chosen_area(F.lit(None).cast("string"), F.when(key % 2 == 0, state), county)
    return b.placed_orders(spark, d).select("o_orderkey", chosen.alias("geo_code"))


@query(
    "year_end_date",
    "SELECT geo_code, year, make_date(year, 12, 31) AS year_end, make_date(year, 1, 1) AS year_start, CAST(year(make_date(year, 12, 31)) AS INTEGER) AS back FROM fx_pop",
)
def year_end_date(spark, d):
    rows = b.population(spark, d).select("geo_code", "year", year_end(F.col("year")).alias("year_end"), year_start(F.col("year")).alias("year_start"))
    return rows.withColumn("back", F.year("year_end"))


@query(
    "delta_addback",
    f"""SELECT m.entity, m.period, {r('b + a * coalesce(pop_lag1, 0.0) + coalesce(pop_lag1, 0.0)', 2, 'yhat')}
        FROM mfeat m JOIN (SELECT entity, regr_slope(population - pop_lag1, pop_lag1) AS a,
                                  regr_intercept(population - pop_lag1, pop_lag1) AS b FROM mfeat GROUP BY 1) c USING (entity)""",
)
def delta_addback(spark, d):
    rows = b.month_features(spark, d).withColumn("delta", F.col("population") - F.col("pop_lag1"))
    coefs = fit_linear(rows, "entity", ["pop_lag1"], "delta").withColumn("use_delta", F.lit(True))
    return rounded(predict_known(rows, coefs, "entity", "period", ["pop_lag1"]), yhat=2)


@query(
    "model_names",
    """SELECT o_orderkey, CASE WHEN lower(name) IN ('linear', 'ridge', 'xgb', 'prophet') THEN lower(name) END AS model
       FROM (SELECT o_orderkey, coalesce(CASE o_orderkey % 4 WHEN 0 THEN 'Ridge' WHEN 1 THEN 'XGB' WHEN 2 THEN 'other' END, 'linear') AS name FROM orders)""",
)
def model_names(spark, d):
    key = F.col("o_orderkey") % 4
    name = F.when(key == 0, "Ridge").when(key == 1, "XGB").when(key == 2, "other")
    return b.table(spark, d, "orders").select("o_orderkey", codes.model_name(name).alias("model"))
