"""Joins, merges and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import codes
from ..functions.guarded import year_end
from ..operators import panel as p
from ..operators import quality as q
from ..operators.backtest import wide_predictions
from ..operators.registry import drift_todo
from ..operators.upsert import append_if_absent, update_from, upsert
from ..plans import serve
from ..plans.features import REGRESSORS, with_region
from ..plans.ingest import INDICATOR_KEYS, merge_indicators, scan_batch as batch_rows
from .base import query, r, rounded


@query(
    "left_indicator",
    "SELECT f.geo_code, f.year, f.population, u.value AS unemployment_rate FROM fx_pop f LEFT JOIN fx_rate u USING (geo_code, year)",
)
def left_indicator(spark, d):
    rates = b.unemployment(spark, d).select("geo_code", "year", F.col("value").alias("unemployment_rate"))
    return b.population(spark, d).join(rates, ["geo_code", "year"], "left")


@query(
    "left_region_fallback",
    """SELECT f.geo_code, f.year, g.region, c.value AS region_index FROM fx_pop f
       LEFT JOIN fx_region g ON g.prefix = substr(f.geo_code, 1, 2)
       LEFT JOIN fx_cpi c ON c.geo_code = g.region AND c.year = f.year""",
)
def left_region_fallback(spark, d):
    from ..plans.features import fallback_index

    rows = with_region(b.population(spark, d), b.regions(spark, d))
    prices = F.broadcast(fallback_index(b.shelter_prices(spark, d)))
    return rows.join(prices, "year", "left").select(
        "geo_code", "year", "region", F.try_element_at("index_by_area", F.col("region")).alias("region_index")
    )


@query(
    "left_global_fallback",
    "SELECT f.geo_code, f.year, c.value AS nation_index FROM fx_pop f LEFT JOIN fx_cpi c ON c.geo_code = 'US' AND c.year = f.year",
)
def left_global_fallback(spark, d):
    from ..plans.features import fallback_index

    prices = F.broadcast(fallback_index(b.shelter_prices(spark, d)))
    return b.population(spark, d).join(prices, "year", "left").select(
        "geo_code", "year", F.try_element_at("index_by_area", F.lit(codes.NATION)).alias("nation_index")
    )


@query("cutin_filter", "SELECT geo_code, year, population FROM matrix")
def cutin_filter(spark, d):
    return p.cut_in(b.joined(spark, d), "geo_code", "year", "has_full_features", b.FLOOR_YEAR).select("geo_code", "year", "population")


@query(
    "anti_unbacked",
    """SELECT f.geo_code, f.year, f.population FROM fx_pop f
       WHERE NOT EXISTS (SELECT 1 FROM fx_ind i WHERE i.geo_code = f.geo_code AND i.year = f.year AND i.indicator_code = 'ACS1_TOTAL_POP')""",
)
def anti_unbacked(spark, d):
    mirrors = b.indicators(spark, d).filter(F.col("indicator_code").isin("ACS1_TOTAL_POP"))
    return q.orphan_rows(b.population(spark, d), mirrors, ["geo_code", "year"])


@query(
    "coverage_by_type",
    """SELECT indicator_code, geo_type, count(*) AS rows FROM fx_ind JOIN fx_geo USING (geo_code) GROUP BY 1, 2""",
)
def coverage_by_type(spark, d):
    return q.coverage_by_area_type(b.indicators(spark, d), b.geography(spark, d), ["indicator_code"])


@query(
    "entities_with_data",
    "SELECT geo_code, geo_name, geo_type FROM fx_geo WHERE geo_type = 'state' AND geo_code IN (SELECT geo_code FROM matrix)",
)
def entities_with_data(spark, d):
    return serve.areas_of_type(b.geography(spark, d), "state", b.matrix(spark, d))


@query("nations", "SELECT geo_code, geo_name, geo_type FROM fx_geo WHERE geo_type = 'nation' AND geo_code IN (SELECT geo_code FROM matrix)")
def nations(spark, d):
    return serve.areas_of_type(b.geography(spark, d), "nation", b.matrix(spark, d))


@query("children_of", "SELECT geo_code, geo_name, geo_type FROM fx_geo WHERE geo_type = 'county' AND geo_code LIKE '06%'")
def children_of(spark, d):
    return serve.areas_of_type(b.geography(spark, d), "county", within="06")


FORECAST_SQL = """fc AS (
  SELECT geo_code, make_date(year + k, 12, 31) AS ds, pop_lag1 + k AS yhat, CAST(year + k AS INTEGER) AS year
  FROM matrix, (SELECT unnest([0, 1]) AS k) s)"""


def _forecasts(spark, d):
    shift = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = b.matrix(spark, d).select("geo_code", "year", "pop_lag1").withColumn("k", shift)
    return rows.select(
        "geo_code", year_end(F.col("year") + F.col("k")).alias("ds"), (F.col("pop_lag1") + F.col("k")).alias("yhat"), (F.col("year") + F.col("k")).alias("year")
    )


@query(
    "attach_actuals",
    "SELECT geo_code, ds, yhat, CAST(population AS DOUBLE) AS actual FROM fc LEFT JOIN fx_pop USING (geo_code, year)",
    ",\n" + FORECAST_SQL,
)
def attach_actuals(spark, d):
    return serve.attach_actuals(_forecasts(spark, d).drop("year"), b.population(spark, d))


@query(
    "predictions_vs_actuals",
    """SELECT geo_code, year, yhat AS predicted, CAST(population AS DOUBLE) AS actual FROM fc
       LEFT JOIN (SELECT * FROM fx_pop WHERE year BETWEEN 2000 AND 2001) USING (geo_code, year)""",
    ",\n" + FORECAST_SQL,
)
def predictions_vs_actuals(spark, d):
    return serve.predictions_vs_actuals(_forecasts(spark, d), b.population(spark, d), 2000, 2001)


@query(
    "wide_model_compare",
    """SELECT geo_code AS entity, CAST(year(trained_at) * 12 + month(trained_at) AS INTEGER) AS period,
         max(CAST(rows AS DOUBLE)) FILTER (WHERE model = '1-URGENT') AS yhat_a,
         max(CAST(rows AS DOUBLE)) FILTER (WHERE model = '2-HIGH') AS yhat_b,
         max(CAST(rows AS DOUBLE)) FILTER (WHERE model = '5-LOW') AS yhat_c
       FROM fx_runs GROUP BY 1, 2""",
)
def wide_model_compare(spark, d):
    period = (F.year("trained_at") * 12 + F.month("trained_at")).alias("period")
    one = b.runs(spark, d).groupBy(F.col("geo_code").alias("entity"), period, "model").agg(F.max("rows").cast("double").alias("yhat"))
    wide = wide_predictions(one, "entity", "period", ["1-URGENT", "2-HIGH", "5-LOW"])
    return wide.withColumnsRenamed({"yhat_1-URGENT": "yhat_a", "yhat_2-HIGH": "yhat_b", "yhat_5-LOW": "yhat_c"})


@query(
    "update_from",
    """SELECT t.key, t.cust, CASE WHEN s.key IS NULL THEN t.value ELSE s.value END AS value,
              CASE WHEN s.key IS NULL THEN t.status ELSE s.source END AS status, t.source
       FROM fx_rows t LEFT JOIN (SELECT key, value * 2 AS value, source FROM fx_rows WHERE key % 3 = 0) s ON s.key = t.key""",
)
def update_from_(spark, d):
    rows = b.order_rows(spark, d)
    source = rows.filter(F.col("key") % 3 == 0).select("key", (F.col("value") * 2).alias("value"), "source")
    return update_from(rows, source, ["key"], {"value": "value", "status": "source"})


@query(
    "drift_todo",
    """SELECT l.geo_code, m.model, l.live_hash, s.stored_hash
       FROM (SELECT geo_code, md5(string_agg(CAST(year AS VARCHAR) || '|' || CAST(population AS VARCHAR), chr(10) ORDER BY year)) AS live_hash
             FROM fx_pop GROUP BY 1) l
       CROSS JOIN (VALUES ('linear'), ('ridge')) AS m(model)
       LEFT JOIN (SELECT geo_code, CASE WHEN idx % 5 = 0 THEN 'old' ELSE hash END AS stored_hash
                  FROM (SELECT geo_code, md5(string_agg(CAST(year AS VARCHAR) || '|' || CAST(population AS VARCHAR), chr(10) ORDER BY year)) AS hash,
                               sum(population) AS idx FROM fx_pop GROUP BY 1) WHERE idx % 3 <> 0) s ON s.geo_code = l.geo_code
       WHERE s.stored_hash IS DISTINCT FROM l.live_hash""",
)
def drift(spark, d):
    people = b.population(spark, d)
    live = p.fingerprint(people, "geo_code", "year", ["year", "population"])
    totals = people.groupBy("geo_code").agg(F.sum("population").alias("idx"))
    stored = live.join(totals, "geo_code").filter(F.col("idx") % 3 != 0)
    stored = stored.withColumn("data_hash", F.when(F.col("idx") % 5 == 0, "old").otherwise(F.col("data_hash")))
    stored = stored.withColumn("model", F.explode(F.array(F.lit("linear"), F.lit("ridge"))))
    return drift_todo(live, stored, ["linear", "ridge"])


@query(
    "fk_violations",
    """SELECT geo_code, count(*) AS rows FROM fx_ind WHERE geo_code NOT IN (SELECT geo_code FROM fx_geo WHERE geo_type <> 'region' AND geo_code <> '03') GROUP BY 1""",
)
def fk_violations(spark, d):
    kept = b.geography(spark, d).filter((F.col("geo_type") != "region") & (F.col("geo_code") != "03"))
    return q.orphan_keys(b.indicators(spark, d), kept, "geo_code")


@query(
    "align_regressors",
    f"""SELECT d.geo_code, d.year, {r('avg(f.unemployment_rate)', 6, 'unemployment_rate')}, {r('avg(f.rent_cpi_index)', 6, 'rent_cpi_index')}
        FROM (SELECT geo_code, CAST(unnest(range(1999, 2004)) AS INTEGER) AS year FROM (SELECT DISTINCT geo_code FROM matrix)) d
        LEFT JOIN matrix f USING (geo_code, year) GROUP BY 1, 2""",
)
def align_regressors(spark, d):
    matrix = b.matrix(spark, d)
    means = matrix.groupBy("geo_code", "year").agg(F.avg("unemployment_rate").alias("unemployment_rate"), F.avg("rent_cpi_index").alias("rent_cpi_index"))
    return rounded(p.densify(means, "geo_code", "year", 1999, 2003), unemployment_rate=6, rent_cpi_index=6)


# ---- Merges -------------------------------------------------------------------

UPSERT_SQL = """tgt AS (SELECT * FROM fx_rows WHERE key % 2 = 1 OR key % 20 = 0),
upd AS (
  SELECT key, cust + 1 AS cust, value * 2 AS value, status, source, CAST(1 AS INTEGER) AS ord FROM fx_rows WHERE key % 2 = 0
  UNION ALL SELECT key, cust + 2, value * 3, status, source, 2 FROM fx_rows WHERE key % 40 = 0
),
lastupd AS (SELECT * FROM upd QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord DESC) = 1),
firstupd AS (SELECT * FROM upd QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord) = 1)"""


def _merge_inputs(spark, d):
    rows, key = b.order_rows(spark, d), F.col("key")
    target = rows.filter((key % 2 == 1) | (key % 20 == 0))
    first = rows.filter(key % 2 == 0).withColumns({"cust": F.col("cust") + 1, "value": F.col("value") * 2, "ord": F.lit(1)})
    second = rows.filter(key % 40 == 0).withColumns({"cust": F.col("cust") + 2, "value": F.col("value") * 3, "ord": F.lit(2)})
    return target, first.unionByName(second)


ALL = "key, cust, value, status, source"


@query(
    "append_if_absent",
    f"SELECT {ALL} FROM tgt UNION ALL SELECT {ALL} FROM firstupd WHERE key NOT IN (SELECT key FROM tgt)",
    ",\n" + UPSERT_SQL,
)
def append_rows(spark, d):
    target, updates = _merge_inputs(spark, d)
    return target.unionByName(append_if_absent(target, updates, ["key"], order="ord"))


@query(
    "upsert_last_wins",
    f"SELECT {ALL} FROM tgt WHERE key NOT IN (SELECT key FROM upd) UNION ALL SELECT {ALL} FROM lastupd",
    ",\n" + UPSERT_SQL,
)
def upsert_last_wins(spark, d):
    target, updates = _merge_inputs(spark, d)
    return upsert(target, updates, ["key"], order="ord")


@query(
    "upsert_all_cols",
    f"SELECT {ALL} FROM tgt WHERE key NOT IN (SELECT key FROM upd) UNION ALL SELECT key, cust, value, NULL, source FROM lastupd",
    ",\n" + UPSERT_SQL,
)
def upsert_all_cols(spark, d):
    """A NULL in the update replaces the stored value."""
    target, updates = _merge_inputs(spark, d)
    return upsert(target, updates.withColumn("status", F.lit(None).cast("string")), ["key"], order="ord")


@query(
    "upsert_partial_cols",
    """SELECT coalesce(t.key, u.key) AS key, CASE WHEN t.key IS NULL THEN u.cust ELSE t.cust END AS cust,
         CASE WHEN u.key IS NULL THEN t.value ELSE u.value END AS value,
         CASE WHEN t.key IS NULL THEN u.status ELSE t.status END AS status,
         CASE WHEN u.key IS NULL THEN t.source ELSE u.source END AS source
       FROM tgt t FULL JOIN lastupd u ON u.key = t.key""",
    ",\n" + UPSERT_SQL,
)
def upsert_partial_cols(spark, d):
    target, updates = _merge_inputs(spark, d)
    return upsert(target, updates, ["key"], order="ord", update_cols=["value", "source"])


DIM_SQL = """stored AS (SELECT geo_code, 'old ' || geo_name AS geo_name, geo_type FROM fx_geo WHERE length(geo_code) <> 5 OR substr(geo_code, 4, 2) = '01'),
incoming AS (SELECT geo_code, max_by(geo_name || ' ' || CAST(year AS VARCHAR), year) AS geo_name, max(geo_type) AS geo_type FROM fx_survey GROUP BY 1)"""


def _dimension(spark, d):
    stored = b.geography(spark, d).filter((F.length("geo_code") != 5) | (F.substring("geo_code", 4, 2) == "01"))
    stored = stored.withColumn("geo_name", F.concat(F.lit("old "), "geo_name"))
    named = b.survey_rows(spark, d).withColumn("geo_name", F.concat_ws(" ", "geo_name", F.col("year").cast("string")))
    incoming = named.groupBy("geo_code").agg(F.max_by("geo_name", "year").alias("geo_name"), F.max("geo_type").alias("geo_type"))
    return stored, incoming


@query(
    "dim_upsert_update",
    """SELECT coalesce(i.geo_code, s.geo_code) AS geo_code, coalesce(i.geo_name, s.geo_name) AS geo_name, coalesce(i.geo_type, s.geo_type) AS geo_type
       FROM stored s FULL JOIN incoming i ON i.geo_code = s.geo_code""",
    ",\n" + DIM_SQL,
)
def dim_upsert_update(spark, d):
    stored, incoming = _dimension(spark, d)
    return upsert(stored, incoming, ["geo_code"])


@query(
    "dim_insert_ignore",
    """SELECT coalesce(s.geo_code, i.geo_code) AS geo_code, coalesce(s.geo_name, i.geo_name) AS geo_name, coalesce(s.geo_type, i.geo_type) AS geo_type
       FROM stored s FULL JOIN incoming i ON i.geo_code = s.geo_code""",
    ",\n" + DIM_SQL,
)
def dim_insert_ignore(spark, d):
    stored, incoming = _dimension(spark, d)
    return upsert(stored, incoming, ["geo_code"], on_conflict="ignore")


@query(
    "fact_upsert",
    """SELECT coalesce(u.geo_code, f.geo_code) AS geo_code, coalesce(u.year, f.year) AS year, coalesce(u.population, f.population) AS population
       FROM (SELECT * FROM fx_pop WHERE year <= 1999) f
       FULL JOIN (SELECT geo_code, year, population FROM fx_survey WHERE source = 'ACS5' AND year >= 1999) u ON u.geo_code = f.geo_code AND u.year = f.year""",
)
def fact_upsert(spark, d):
    stored = b.population(spark, d).filter(F.col("year") <= 1999)
    updates = b.survey_rows(spark, d).filter((F.col("source") == "ACS5") & (F.col("year") >= 1999))
    return upsert(stored, updates, ["geo_code", "year"])


@query(
    "indicator_upsert",
    """SELECT coalesce(u.geo_code, f.geo_code) AS geo_code, coalesce(u.year, f.year) AS year, coalesce(u.indicator_code, f.indicator_code) AS indicator_code,
         coalesce(u.value, f.value) AS value, coalesce(f.source, u.source) AS source, coalesce(f.unit, u.unit) AS unit, coalesce(u.etl_batch_id, f.etl_batch_id) AS etl_batch_id
       FROM (SELECT * FROM fx_ind WHERE year <= 1999) f
       FULL JOIN (SELECT geo_code, year, indicator_code, value + 1 AS value, 'new' AS source, unit, 'batch_2' AS etl_batch_id FROM fx_ind WHERE year >= 1999) u
         ON u.geo_code = f.geo_code AND u.year = f.year AND u.indicator_code = f.indicator_code""",
)
def indicator_upsert(spark, d):
    rows = b.indicators(spark, d).drop("updated_at")
    updates = rows.filter(F.col("year") >= 1999).withColumns(
        {"value": F.col("value") + 1, "source": F.lit("new"), "etl_batch_id": F.lit("batch_2")}
    )
    wanted = [*codes.SURVEY_INDICATORS.values(), codes.UNEMPLOYMENT, codes.SHELTER_PRICES]
    return merge_indicators(rows.filter(F.col("year") <= 1999), updates, wanted).select(*INDICATOR_KEYS, "value", "source", "unit", "etl_batch_id")


@query(
    "scan_batch",
    "SELECT geo_code, year, source, population FROM fx_survey WHERE year % 3 = 1",
)
def scan_batch(spark, d):
    batch = F.concat(F.lit("batch_"), (F.col("year") % 3).cast("string"))
    staged = b.survey_rows(spark, d).withColumn("etl_batch_id", batch)
    return batch_rows(staged, "batch_1").select("geo_code", "year", "source", "population")


# ---- Set operations -------------------------------------------------------------


@query(
    "union_relaxed",
    """SELECT geo_code, year, population, source, geo_name FROM fx_survey WHERE source = 'ACS1'
       UNION ALL SELECT geo_code, year, population, source, NULL FROM fx_survey WHERE source = 'ACS5'""",
)
def union_relaxed(spark, d):
    rows = b.survey_rows(spark, d).drop("geo_type")
    first = rows.filter(F.col("source") == "ACS1")
    second = rows.filter(F.col("source") == "ACS5").drop("geo_name").withColumn("year", F.col("year").cast("bigint"))
    return p.union_all([first, second.withColumn("year", F.col("year").cast("int"))], relaxed=True)


@query("union_backtest_future", "SELECT geo_code, year, pop_lag1 AS yhat FROM matrix UNION ALL SELECT geo_code, CAST(year + 1 AS INTEGER), population FROM matrix WHERE year = 2001")
def union_backtest_future(spark, d):
    matrix = b.matrix(spark, d)
    known = matrix.select("geo_code", "year", F.col("pop_lag1").alias("yhat"))
    later = matrix.filter(F.col("year") == 2001).select("geo_code", (F.col("year") + 1).alias("year"), F.col("population").alias("yhat"))
    return p.union_all([known, later])


@query("distinct_dims", "SELECT DISTINCT geo_code, geo_type FROM fx_survey")
def distinct_dims(spark, d):
    return b.survey_rows(spark, d).select("geo_code", "geo_type").distinct()


@query(
    "series_long",
    """SELECT geo_code, year, 'actual' AS label, CAST(population AS DOUBLE) AS value FROM fx_pop WHERE year BETWEEN 1998 AND 2001
       UNION ALL SELECT geo_code, year, 'lag', pop_lag1 FROM matrix UNION ALL SELECT geo_code, year, 'lag5', pop_lag5 FROM matrix""",
)
def series_long(spark, d):
    matrix = b.matrix(spark, d)
    pairs = F.array(
        F.struct(F.lit("lag").alias("model"), F.col("pop_lag1").alias("yhat")),
        F.struct(F.lit("lag5").alias("model"), F.col("pop_lag5").alias("yhat")),
    )
    predictions = matrix.select("geo_code", "year", F.inline(pairs))
    return serve.series_long(b.population(spark, d), predictions, 1998, 2001)


@query(
    "feature_diff",
    "SELECT geo_code, array_to_string(list_sort(list_filter(['pop_lag1','pop_lag5','unemployment_rate','rent_cpi_index'], lambda x: NOT list_contains(known, x))), ',') AS missing, "
    "array_to_string(list_sort(list_filter(known, lambda x: NOT list_contains(['pop_lag1','pop_lag5','unemployment_rate','rent_cpi_index'], x))), ',') AS extra FROM ("
    "SELECT geo_code, list_filter([CASE WHEN count(pop_lag1) >= 3 THEN 'pop_lag1' END, CASE WHEN count(pop_lag5) >= 3 THEN 'pop_lag5' END, 'pop_ma3', "
    "CASE WHEN count(unemployment_rate) >= 3 THEN 'unemployment_rate' END], lambda x: x IS NOT NULL) AS known FROM joined GROUP BY 1)",
)
def feature_diff(spark, d):
    usable = p.usable_features(b.joined(spark, d), "geo_code", ["pop_lag1", "pop_lag5", "unemployment_rate"])
    known = F.array_append("features", F.lit("pop_ma3"))
    wanted = F.array(*[F.lit(c) for c in REGRESSORS])

    def listed(a, c):
        return F.array_join(F.sort_array(F.array_except(a, c)), ",")

    return usable.select("geo_code", listed(wanted, known).alias("missing"), listed(known, wanted).alias("extra"))
