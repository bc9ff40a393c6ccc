"""Landed documents, sinks, snapshots and ingest jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators.regression import fit_linear
from ..plans import ingest
from ..plans.features import REGRESSORS
from ..plans.refresh import apply_facts, read_matrix
from ..session import fresh_dir, stored
from ..sources import audit, documents as docs, files, models as stored_models, snapshots, variants
from ..streaming.landing import ingest_landed
from .base import query, r, rounded
from .columns import MATRIX_DIGITS, MATRIX_SQL
from .model_sql import fit_sql


def _landed(spark, df, *partitions):
    """Write documents as text files, as a collector would, and read them back."""
    path = fresh_dir(spark, "landing")
    writer = df.withColumnRenamed("doc", "value").write
    (writer.partitionBy(*partitions) if partitions else writer).text(path)
    return docs.read_documents(spark, path)


@query("src_series_json", "SELECT series_id, year, period, value FROM mpoints")
def src_series_json(spark, d):
    points, _ = docs.series_points(_landed(spark, b.series_documents(spark, d)))
    return points


TABLE_SQL = """SELECT geo_code, geo_name, geo_type, year, CASE WHEN geo_type = 'county' THEN population ELSE population END AS population, source
  FROM fx_survey WHERE NOT (source = 'ACS1' AND year = 2001)"""


def _tables(spark, d):
    landed = _landed(spark, b.table_documents(spark, d), "survey", "level", "year")
    parts = [docs.table_rows(landed.filter(F.col("level") == level), level) for level in ("nation", "state", "county")]
    rows = parts[0][0].unionByName(parts[1][0]).unionByName(parts[2][0])
    bad = parts[0][1].unionByName(parts[1][1]).unionByName(parts[2][1])
    return rows, bad


@query("src_header_array_json", TABLE_SQL)
def src_header_array_json(spark, d):
    return _tables(spark, d)[0]


@query(
    "src_observations_json",
    "SELECT series_id, obs_date, raw_value FROM obs",
)
def src_observations_json(spark, d):
    rows, _ = docs.observations(_landed(spark, b.observation_documents(spark, d), "series_id"))
    return rows


@query(
    "src_quarantine",
    """SELECT reason, count(*) AS documents FROM (
         SELECT 'missing columns: B01001_001E' AS reason FROM fx_survey WHERE source = 'ACS1' AND year = 2001
         GROUP BY geo_type, CASE WHEN geo_type = 'county' THEN substr(geo_code, 1, 2) END
         UNION ALL SELECT unnest(['request failed', 'not a response document'])) GROUP BY 1""",
)
def src_quarantine(spark, d):
    """Rejected documents by reason; the good ones of the same folders are kept."""
    _, bad_tables = _tables(spark, d)
    _, bad_series = docs.series_points(_landed(spark, b.series_documents(spark, d)))
    reasons = bad_tables.select("reason").unionByName(bad_series.select("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("documents"))


@query(
    "raw_audit_append",
    """SELECT endpoint, params_json, payload_json, count(*) AS rows FROM (
         SELECT DISTINCT 'https://api/' || o_orderpriority AS endpoint, '{"page":"' || CAST(o_custkey % 7 AS VARCHAR) || '"}' AS params_json,
                '{"registrationkey":"***"}' AS payload_json FROM orders) GROUP BY ALL""",
)
def raw_audit_append(spark, d):
    """Calls repeat in two batches and with different keys; each is logged once."""
    orders = b.table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    calls = orders.select(
        F.concat(F.lit("batch_"), (F.col("o_orderkey") % 2).cast("string")).alias("etl_batch_id"),
        F.col("o_orderdate").alias("requested_at"),
        F.concat(F.lit("https://api/"), "o_orderpriority").alias("endpoint"),
        F.create_map(F.lit("page"), (F.col("o_custkey") % 7).cast("string"), F.lit("api_key"), key, F.lit("_batch_id"), key).alias("params"),
        F.create_map(F.lit("registrationkey"), key).alias("payload"),
        F.lit(200).alias("http_status"),
        F.lit("{}").alias("response_json"),
        F.lit(None).cast("string").alias("notes"),
        F.col("o_orderkey").alias("_k"),
    )
    calls = calls.withColumn("params", F.map_filter("params", lambda k, _: k != "_batch_id"))
    empty = audit.audit_rows(calls.filter(F.lit(False)))
    first = audit.new_calls(empty, calls.filter(F.col("_k") % 2 == 0))
    log = first.unionByName(audit.new_calls(first, calls.filter(F.col("_k") % 2 == 1)))
    return log.groupBy("endpoint", "params_json", "payload_json").agg(F.count("*").alias("rows"))


@query(
    "json_params",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}' AS params FROM events""",
)
def json_params(spark, d):
    events = b.table(spark, d, "events")
    k = audit.json_text("props", "k").try_cast("int")
    return events.select("event_id", k.alias("k"), audit.as_json(["event_type", "user_id"]).alias("params"))


@query(
    "variant_fields",
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS kind,
         CASE WHEN user_id % 5 <> 0 AND event_id % 7 <> 0 THEN user_id END AS who,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN event_id % 7 = 0 THEN 'raw' ELSE '' END AS faults
       FROM events""",
)
def variant_fields(spark, d):
    """Two JSON columns parsed once and stored as Variant; every seventh document is cut short, some numbers are words."""
    who = F.when(F.col("user_id") % 5 == 0, F.lit('"unknown"')).otherwise(F.col("user_id").cast("string"))
    text = F.concat(F.lit('{"type":"'), "event_type", F.lit('","user":{"ids":['), who, F.lit("]}}"))
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(text, 1, 12)).otherwise(text)
    docs = b.table(spark, d, "events").select("event_id", "props", cut.alias("raw"))
    kept = stored(variants.parsed(docs, "raw", "props"), "variants")
    rows = variants.fields(kept, "raw", {"kind": ("$.type", "string"), "who": ("$.user.ids[0]", "bigint")})
    return rows.select("event_id", "kind", "who", variants.field("props", "$.k", "int").alias("k"), F.array_join("malformed", ",").alias("faults"))


@query(
    "variant_shapes",
    """SELECT event_type, 'OBJECT<' || CASE WHEN max(event_id % 3) = 2 THEN 'id: BIGINT, ' ELSE '' END || 'k: BIGINT>' AS shape, count(*) AS documents
       FROM events GROUP BY 1""",
)
def variant_shapes(spark, d):
    """The common schema of each event type's documents, some of which carry an id."""
    tail = F.concat(F.lit(', "id": '), F.col("event_id").cast("string"), F.lit("}"))
    text = F.when(F.col("event_id") % 3 == 2, F.concat(F.rtrim("props", F.lit("}")), tail)).otherwise(F.col("props"))
    docs = b.table(spark, d, "events").select("event_type", text.alias("doc"))
    return variants.shapes(variants.parsed(docs, "doc"), "doc", ["event_type"])


@query("refresh_snapshot", f"SELECT {MATRIX_SQL} FROM matrix")
def refresh_snapshot(spark, d):
    """Publish the matrix twice; the second version is the one read back."""
    root = fresh_dir(spark, "matrix")
    matrix = b.matrix(spark, d)
    snapshots.publish(matrix.limit(1), root)
    snapshots.publish(matrix, root, sort_by=["geo_code", "year"])
    return rounded(snapshots.read_snapshot(spark, root).drop("has_full_features"), **MATRIX_DIGITS)


@query("matrix_refresh", f"SELECT {MATRIX_SQL} FROM matrix")
def matrix_refresh(spark, d):
    """Three batches, the last of which corrects what the first two had wrong; only changed areas are recomputed."""
    root, facts = fresh_dir(spark, "features"), stored(b.stacked_facts(spark, d), "facts")
    even, odd = F.pmod(F.xxhash64("geo_code", "year", "indicator_code"), F.lit(2)) == 0, F.col("year") % 2 == 1
    wrong = facts.withColumn("value", F.when(odd & even, F.col("value") + 1).otherwise(F.col("value")))
    regions = b.regions(spark, d)
    for part in (wrong.filter(even), facts.filter(~even), facts.filter(odd)):
        apply_facts(spark, root, part, regions, b.FLOOR_YEAR)
    return rounded(read_matrix(spark, root).drop("has_full_features"), **MATRIX_DIGITS)


@query(
    "audit_log",
    """SELECT endpoint, count(*) AS calls FROM (SELECT DISTINCT o_orderpriority AS endpoint, o_custkey FROM orders) GROUP BY 1""",
)
def audit_log(spark, d):
    """Calls of two files, each logged once; the second file reads only hashes of the folders it falls in."""
    orders = b.table(spark, d, "orders")
    calls = orders.select(
        (F.col("o_orderkey") % 2).cast("string").alias("etl_batch_id"),
        F.col("o_orderdate").alias("requested_at"),
        F.col("o_orderpriority").alias("endpoint"),
        F.create_map(F.lit("customer"), F.col("o_custkey").cast("string")).alias("params"),
        F.lit(None).cast("map<string,string>").alias("payload"),
        F.lit(200).alias("http_status"),
        F.lit("{}").alias("response_json"),
        F.lit(None).cast("string").alias("notes"),
    )
    path = fresh_dir(spark, "calls")
    for batch in ("0", "1", "1"):
        audit.record_calls(spark, path, calls.filter(F.col("etl_batch_id") == batch))
    return spark.read.parquet(path).groupBy("endpoint").agg(F.count("*").alias("calls"))


@query("sink_csv", "SELECT geo_code AS geo, source AS model, CAST(population AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS mse, CAST(year AS DOUBLE) AS rmse FROM fx_survey")
def sink_csv(spark, d):
    path = fresh_dir(spark, "metrics")
    rows = b.survey_rows(spark, d).select(
        F.col("geo_code").alias("geo"), F.col("source").alias("model"), F.col("population").alias("mae"), F.col("year").alias("rmse")
    )
    files.append_metrics(rows.filter(F.col("model") == "ACS1"), path)
    files.append_metrics(rows.filter(F.col("model") == "ACS5"), path)
    return files.read_csv(spark, path, files.METRICS_LOG_SCHEMA).drop("notes")


@query("src_forecast_csv", "SELECT year, CAST(population AS DOUBLE) AS yhat_prophet FROM fx_pop")
def src_forecast_csv(spark, d):
    path = fresh_dir(spark, "forecasts")
    rows = b.population(spark, d).select(F.make_date("year", F.lit(12), F.lit(31)).alias("ds"), F.col("population").cast("double").alias("yhat"))
    files.write_csv(rows, path)
    return files.read_forecast_csv(spark, path, "yhat_prophet")


@query(
    "sink_json_report",
    "SELECT 'acs' AS source, count(*) AS rows, count(DISTINCT geo_code) AS geos, min(year) AS year_min, max(year) AS year_max FROM fx_survey",
)
def sink_json_report(spark, d):
    from ..operators.quality import validation_report

    path = fresh_dir(spark, "report")
    files.write_json_report(validation_report(b.survey_rows(spark, d), "acs", "population", "population", "geo_code"), path)
    return spark.read.schema("source string, rows bigint, geos bigint, year_min int, year_max int").json(path)


@query(
    "model_table_roundtrip",
    f"SELECT entity, 'ridge' AS model, {r('x_1', 6, 'c1')}, {r('x0', 0, 'intercept')} FROM fit WHERE n >= 8",
    ",\n" + fit_sql("fit", "mfeat", "entity", REGRESSORS, alpha=1.0),
)
def model_table_roundtrip(spark, d):
    path = fresh_dir(spark, "models")
    rows = b.month_features(spark, d)
    for alpha in (0.0, 1.0):
        coefs = fit_linear(rows, "entity", REGRESSORS, "population", alpha=alpha).filter(F.col("train_rows") >= 8)
        stored_models.save_models(coefs, path, "entity")
    loaded = stored_models.load_models(spark, path, ["ridge"])
    return loaded.select("entity", "model", F.round(F.col("coef")[0], 6).alias("c1"), F.round("intercept", 0).alias("intercept"))


@query(
    "artifact_keys",
    """SELECT stem, 'ridge' AS family, CASE WHEN stem LIKE '%!_%' ESCAPE '!' THEN split_part(stem, '_', 1) ELSE 'ridge' END AS model,
         CASE WHEN stem LIKE '%!_%' ESCAPE '!' THEN substr(stem, instr(stem, '_') + 1) ELSE stem END AS geo_code
       FROM (SELECT CASE WHEN length(geo_code) = 2 THEN geo_code ELSE 'linear_' || geo_code END AS stem FROM fx_geo)""",
)
def artifact_keys(spark, d):
    stem = F.when(F.length("geo_code") == 2, F.col("geo_code")).otherwise(F.concat(F.lit("linear_"), "geo_code"))
    names = b.geography(spark, d).select(stem.alias("stem"), F.lit("ridge").alias("family"))
    return stored_models.artifact_keys(names)


# ---- Ingest jobs -------------------------------------------------------------------


@query(
    "pipeline_surveys",
    """SELECT i.geo_code, i.year, i.indicator_code, i.value, i.source, i.unit, c.population
       FROM (SELECT * FROM fx_ind WHERE indicator_code LIKE 'ACS%' AND NOT (source = 'ACS1' AND year = 2001)) i
       JOIN (SELECT * FROM fx_survey WHERE NOT (source = 'ACS1' AND year = 2001) QUALIFY row_number() OVER (PARTITION BY geo_code, year ORDER BY
               CASE WHEN geo_type = 'county' THEN source <> 'ACS5' ELSE source <> 'ACS1' END) = 1) c USING (geo_code, year)""",
)
def pipeline_surveys(spark, d):
    rows, _ = _tables(spark, d)
    batch = ingest.load_surveys(ingest.empty_core(spark), None, rows, "batch_1")
    return batch.core.indicators.drop("etl_batch_id").join(batch.core.population, ["geo_code", "year"])


@query(
    "pipeline_unemployment",
    f"""SELECT substr(series_id, 6, 2) AS geo_code, year, 'BLS_UNRATE' AS indicator_code, {r('value', 4, 'value')}, 'BLS' AS source, 'percent' AS unit, 'b1' AS etl_batch_id
        FROM annual WHERE series_id LIKE 'LASST%' AND value BETWEEN 0 AND 100""",
)
def pipeline_unemployment(spark, d):
    points, _ = docs.series_points(_landed(spark, b.series_documents(spark, d)))
    core = ingest.load_unemployment(ingest.empty_core(spark), points, "b1").core
    return rounded(core.indicators, value=4)


@query(
    "pipeline_national",
    f"SELECT 'US' AS geo_code, year, {r('value', 4, 'value')}, 'nation' AS geo_type FROM annual WHERE series_id = 'LASST010000000000003' AND value BETWEEN 0 AND 100",
)
def pipeline_national(spark, d):
    points = b.monthly_points(spark, d).filter(F.col("series_id") == "LASST010000000000003")
    core = ingest.load_national_unemployment(ingest.empty_core(spark), points, "b1").core
    return rounded(core.indicators.join(core.geography, "geo_code").select("geo_code", "year", "value", "geo_type"), value=4)


@query(
    "pipeline_prices",
    f"""SELECT CASE series_id WHEN 'CUUR0000SAH1' THEN 'US' ELSE 'R' || substr(series_id, 6, 1) END AS geo_code, CAST(year(obs_date) AS INTEGER) AS year,
          {r('avg(TRY_CAST(nullif(raw_value, chr(46)) AS DOUBLE))', 4, 'value')} FROM obs WHERE series_id LIKE 'CUUR%' GROUP BY 1, 2""",
)
def pipeline_prices(spark, d):
    rows, _ = docs.observations(_landed(spark, b.observation_documents(spark, d), "series_id"))
    core = ingest.load_prices(ingest.empty_core(spark), rows, "b1").core
    return rounded(core.indicators.select("geo_code", "year", "value"), value=4)


@query(
    "latest_observation",
    "SELECT series_id, max(year) AS year, max_by(TRY_CAST(nullif(value, '.') AS DOUBLE), (year, period)) AS value FROM mpoints GROUP BY 1",
)
def latest_observation(spark, d):
    return docs.latest_points(b.series_documents(spark, d))


@query(
    "pipeline_baseline",
    """SELECT 'US' AS geo_code, year, 'ACS_TOTAL_POP' AS indicator_code, CAST(population AS DOUBLE) AS value, 'ACS' AS source FROM fx_pop WHERE geo_code = 'US' AND year = 2000
       UNION ALL SELECT 'US', max(year), 'BLS_UNRATE', max_by(CAST(value AS DOUBLE), (year, period)), 'BLS' FROM mpoints WHERE series_id = 'LASST030000000000003'""",
)
def pipeline_baseline(spark, d):
    point = F.struct(F.col("year").cast("string").alias("year"), "period", "value")
    one = b.monthly_points(spark, d).filter(F.col("series_id") == "LASST030000000000003").groupBy("series_id").agg(
        F.sort_array(F.collect_list(point), False).alias("data")
    )
    series = F.array(F.struct(F.col("series_id").alias("seriesID"), "data")).alias("series")
    rate_docs = one.select(F.to_json(F.struct(F.lit("REQUEST_SUCCEEDED").alias("status"), F.struct(series).alias("Results"))).alias("doc"))
    people = b.population(spark, d).filter(F.col("year") == 2000)
    core = ingest.load_baseline(ingest.empty_core(spark), people, rate_docs, "b1").core
    return core.indicators.select("geo_code", "year", "indicator_code", "value", "source")


@query(
    "stream_landing",
    f"""SELECT substr(series_id, 6, 2) AS geo_code, year, {r('value', 4, 'value')} FROM annual
        WHERE series_id LIKE 'LASST%' AND value BETWEEN 0 AND 100""",
)
def stream_landing(spark, d):
    """Documents picked up by two incremental runs; the second finds nothing new."""
    landing, core = fresh_dir(spark, "landing"), fresh_dir(spark, "core")
    b.series_documents(spark, d).withColumnRenamed("doc", "value").write.text(landing)
    checkpoint = fresh_dir(spark, "stream")
    for _ in range(2):
        ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    return rounded(ingest.read_core(spark, core).indicators.select("geo_code", "year", "value"), value=4)
