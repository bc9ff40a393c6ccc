import json

import pytest
from pyspark.sql import functions as F

from panelspark.plans import ingest
from panelspark.plans.export import export_bundle
from panelspark.plans.features import REGRESSORS
from panelspark.session import fresh_dir, shared_dir, stored
from panelspark.sources import audit, documents as docs, files, models, snapshots
from panelspark.streaming.landing import ingest_landed


def series_doc(points, status="REQUEST_SUCCEEDED"):
    series = [{"seriesID": s, "data": [{"year": y, "period": p, "value": v} for y, p, v in ps]} for s, ps in points.items()]
    return json.dumps({"status": status, "Results": {"series": series}})


GOOD = series_doc({"LASST060000000000003": [("2020", "M02", "5.0"), ("2020", "M01", "4.0")], "XXXXX": [("2020", "M01", "1")], "LASST070000000000003": []})


def test_series_documents_are_split(spark, rows):
    lines = [GOOD, series_doc({}, "REQUEST_FAILED"), '{"status": "REQ', "[1, 2]", ""]
    points, bad = docs.series_points(spark.createDataFrame([(x,) for x in lines], "doc string"))
    assert rows(points) == [("LASST060000000000003", 2020, "M01", "4.0"), ("LASST060000000000003", 2020, "M02", "5.0"), ("XXXXX", 2020, "M01", "1")]
    assert sorted(r["reason"] for r in bad.collect()) == ["not a response document"] * 3 + ["request failed"]


def test_table_columns_are_found_by_name(spark, rows):
    tables = [
        [["NAME", "B01001_001E", "state", "county"], ["A", "10", "06", "037"], ["B", None, "06", "001"]],
        [["county", "state", "B01001_001E", "NAME"], ["005", "17", "30", "C"]],
        [["NAME", "state", "county"], ["D", "01", "001"]],
    ]
    landed = [(json.dumps(t), 2020, "acs5") for t in tables] + [('{"error": "x"}', 2020, "acs5"), (json.dumps(tables[0][:1]), 2021, "acs5")]
    found, bad = docs.table_rows(spark.createDataFrame(landed, "doc string, year int, survey string"), "county")
    assert rows(found, "geo_code", "geo_name", "population", "source") == [("06001", "B", None, "ACS5"), ("06037", "A", 10, "ACS5"), ("17005", "C", 30, "ACS5")]
    assert sorted(r["reason"] for r in bad.collect()) == ["missing columns: B01001_001E", "not a table"]


def test_observations_and_prices(spark, rows):
    doc = json.dumps({"observations": [{"date": "2020-01-01", "value": "1"}, {"date": "2020-02-01", "value": "."}, {"date": "bad", "value": "2"}, {"date": "2021-01-01", "value": "."}]})
    df = spark.createDataFrame([("CUUR0100SAH1", doc), ("CUUR0000SAH1", "{}")], "series_id string, doc string")
    obs, bad = docs.observations(df)
    assert obs.count() == 4 and bad.count() == 1
    batch = ingest.load_prices(ingest.empty_core(spark), obs, "b1")
    assert rows(batch.core.indicators, "geo_code", "year", "value", "source", "unit") == [("R1", 2020, 1.0, "FRED", "index")]
    assert rows(batch.core.geography) == [("R1", "Northeast", "region")]


def test_unemployment_batches_merge_and_keep_source(spark, rows):
    points, _ = docs.series_points(spark.createDataFrame([(GOOD,)], "doc string"))
    first = ingest.load_unemployment(ingest.empty_core(spark), points, "b1")
    assert rows(first.core.indicators) == [("06", 2020, "BLS_UNRATE", 4.5, "BLS", "percent", "b1")]
    later, _ = docs.series_points(spark.createDataFrame([(series_doc({"LASST060000000000003": [("2020", "M13", "6.0"), ("2021", "M13", ".")]}),)], "doc string"))
    old = ingest.CoreTables(first.core.geography, first.core.population, first.core.indicators.withColumn("source", F.lit("old")))
    second = ingest.load_unemployment(old, later, "b2").core
    assert rows(second.indicators) == [("06", 2020, "BLS_UNRATE", 6.0, "old", "percent", "b2")]


def test_surveys_mirror_both_sources_and_update_names(spark, rows):
    data = [("06", "Cal", "state", 2019, 9, "ACS1"), ("06", "California", "state", 2020, 10, "ACS1"), ("06", "California", "state", 2020, 11, "ACS5"), ("06037", "LA", "county", 2020, 3, "ACS1")]
    df = spark.createDataFrame(data, "geo_code string, geo_name string, geo_type string, year int, population bigint, source string")
    batch = ingest.load_surveys(ingest.empty_core(spark), None, df, "b1")
    assert rows(batch.core.population) == [("06", 2019, 9), ("06", 2020, 10), ("06037", 2020, 3)]
    assert batch.core.indicators.count() == 4
    assert rows(batch.core.geography, "geo_code", "geo_name") == [("06", "California"), ("06037", "LA")]
    assert {(r["part"], r["rows"]) for r in batch.report.collect()} == {("core", 3), ("all_iv", 4)}


def test_baseline_and_full_indicator_refresh(spark, rows):
    people = spark.createDataFrame([("US", 2021, 330)], "geo_code string, year int, population bigint")
    rates = spark.createDataFrame([(GOOD,)], "doc string")
    core = ingest.load_baseline(ingest.empty_core(spark), people, rates.limit(1), "b1").core
    assert rows(core.indicators.filter("indicator_code = 'ACS_TOTAL_POP'"), "year", "value") == [(2021, 330.0)]
    codes = ["ACS_TOTAL_POP", "BLS_UNRATE"]
    assert ingest.merge_indicators(core.indicators, core.indicators, ["BLS_UNRATE"]).count() == core.indicators.count()
    new = core.indicators.withColumns({"source": F.lit("s2"), "etl_batch_id": F.lit("b2")})
    assert {r["source"] for r in ingest.merge_indicators(core.indicators, new, codes, full=True).collect()} == {"s2"}
    assert "s2" not in {r["source"] for r in ingest.merge_indicators(core.indicators, new, codes).collect()}


def calls(spark, items):
    schema = "etl_batch_id string, requested_at timestamp, endpoint string, params map<string,string>, payload map<string,string>, http_status int, response_json string, notes string"
    return spark.createDataFrame([(b, None, e, p, q, 200, "{}", None) for b, e, p, q in items], schema)


def test_audit_hash_ignores_batch_order_and_secrets(spark):
    items = [
        ("b1", "u", {"b": "2", "a": "1", "api_key": "s1", "_batch_id": "b1"}, {"registrationkey": "k1"}),
        ("b2", "u", {"a": "1", "b": "2", "api_key": "s2", "_batch_id": "b2"}, {"registrationkey": "k2"}),
        ("b2", "u", {"a": "1", "b": "3"}, None),
    ]
    logged = audit.audit_rows(calls(spark, items)).collect()
    assert logged[0]["request_hash"] == logged[1]["request_hash"] != logged[2]["request_hash"]
    assert logged[1]["payload_json"] == '{"registrationkey":"***"}' and "s1" not in logged[0]["params_json"]
    first = audit.new_calls(audit.audit_rows(calls(spark, items[:0])), calls(spark, items[:1]))
    assert audit.new_calls(first, calls(spark, items)).count() == 1


def test_snapshots_switch_atomically(spark, rows):
    root = fresh_dir(spark, "snap")
    df = spark.range(3)
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, root)
    assert snapshots.read_snapshot(spark, root, df.schema).count() == 0
    snapshots.publish(df, root)
    grown = snapshots.read_snapshot(spark, root).union(spark.range(3, 5))
    snapshots.publish(grown, root)
    assert snapshots.read_snapshot(spark, root).count() == 5 and snapshots.current_version(spark, root)[0] == 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))
    assert stored(spark.range(4), "t").count() == 4


def test_stream_handles_each_document_once(spark, rows):
    landing, core, checkpoint = (fresh_dir(spark, n) for n in ("land", "core", "check"))
    spark.createDataFrame([(GOOD,)], "value string").write.text(landing)
    ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    newer = series_doc({"LASST060000000000003": [("2020", "M13", "7.0")], "LASST090000000000003": [("2020", "M13", "3.0")]})
    spark.createDataFrame([(newer,)], "value string").write.mode("append").text(landing)
    ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    assert rows(ingest.read_core(spark, core).indicators, "geo_code", "value", "etl_batch_id") == [("06", 7.0, "b_1"), ("09", 3.0, "b_1")]


def test_metrics_log_and_models(spark, rows):
    log = fresh_dir(spark, "log")
    for geo in ("a", "b"):
        files.append_metrics(spark.createDataFrame([(geo, "linear", 1.5)], "geo string, model string, mae double"), log)
    assert rows(files.read_csv(spark, log, files.METRICS_LOG_SCHEMA), "geo", "mae", "notes") == [("a", 1.5, None), ("b", 1.5, None)]
    coefs = spark.createDataFrame([("a", "linear", ["x"], [1.0], 2.0, False), ("a", "ridge", ["x"], [3.0], 4.0, True)], "e string, model string, features array<string>, coef array<double>, intercept double, use_delta boolean")
    path = fresh_dir(spark, "models")
    models.save_models(coefs, path, "e")
    assert rows(models.load_models(spark, path, ["ridge"]), "e", "intercept", "use_delta") == [("a", 4.0, True)]


def test_export_reports_missing_models(spark):
    years = range(2005, 2012)
    matrix = spark.createDataFrame([("06", y, 100.0 + y, 99.0 + y, 95.0 + y, 5.0, 10.0) for y in years], "geo_code string, year int, population double, pop_lag1 double, pop_lag5 double, unemployment_rate double, rent_cpi_index double")
    indicators = spark.createDataFrame([("06", 2005, "BLS_UNRATE", 5.0, "BLS", "percent")], "geo_code string, year int, indicator_code string, value double, source string, unit string")
    coefs = spark.createDataFrame([("06", "linear", [1.0, 0.0, 0.0, 0.0], 1.0, False)], "geo_code string, model string, coef array<double>, intercept double, use_delta boolean")
    root = fresh_dir(spark, "bundle")
    status = export_bundle(root, indicators, matrix, matrix.select("geo_code", "year", "population"), coefs, REGRESSORS, 2005, 2014).collect()
    assert {(r["dataset"], r["model"], r["status"]) for r in status} == {
        ("indicators", None, "written"), ("feature_matrix", None, "written"), ("predictions", "linear", "written"), ("future_features", "linear", "written"),
        ("predictions", "ridge", "error"), ("predictions", "xgb", "error"), ("predictions", "prophet", "error"),
    }
    assert spark.read.option("header", True).csv(f"{root}/predictions/model=linear").count() == 10
    with pytest.raises(ValueError):
        export_bundle(root, indicators, matrix, matrix, coefs, REGRESSORS, 2014, 2005)


def test_merging_one_indicator_leaves_the_others_unread(spark):
    root = fresh_dir(spark, "core")
    start = ingest.read_core(spark, root)
    rows = [("06", 2020, code, 1.0, "s", "u", "b") for code in ("BLS_UNRATE", "CPI_SHELTER", "ACS1_TOTAL_POP")]
    filled = ingest.CoreTables(start.geography, start.population, spark.createDataFrame(rows, ingest.INDICATOR_SCHEMA))
    ingest.publish_batch(start, ingest.Batch(filled, None, None, ["BLS_UNRATE", "CPI_SHELTER", "ACS1_TOTAL_POP"]), root)
    core = ingest.read_core(spark, root)
    assert core.indicators.count() == 3
    new = spark.createDataFrame([("06", 2021, "BLS_UNRATE", 2.0, "s", "u", "b2")], ingest.INDICATOR_SCHEMA)
    merged = ingest.merge_indicators(core.indicators, new, ["BLS_UNRATE"]).filter("indicator_code = 'BLS_UNRATE'")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 2 and plan.count("FileScan") == 1


def test_bad_rows_go_to_quarantine_and_the_last_row_wins(spark, rows, tmp_path):
    schema = "geo_code string, geo_name string, geo_type string, year int, source string, population bigint, ordinal int"
    data = [("06", "A", "state", 2010, "ACS1", v, v) for v in (1, 2, 5, 3, 4)]
    data += [("07", "B", "state", 2010, "ACS1", -5, 9), ("08", "C", "state", 3000, "ACS1", 7, 10)]
    core, root = ingest.empty_core(spark), str(tmp_path)
    for _ in range(2):  # a rerun changes nothing
        batch = ingest.load_surveys(ingest.read_core(spark, root), None, spark.createDataFrame(data, schema), "b1")
        ingest.publish_batch(core, batch, root)
    assert rows(ingest.read_core(spark, root).population) == [("06", 2010, 5)]
    bad = spark.read.parquet(f"{root}/quarantine/surveys-b1")
    assert sorted((r.geo_code, tuple(r.broken_rules)) for r in bad.collect()) == [
        ("07", ("population_not_negative",)),
        ("08", ("year_in_calendar",)),
    ]
    assert spark.read.parquet(f"{root}/stage/surveys-b1").count() == 1


def test_an_indicator_under_a_new_code_is_read_again(spark, tmp_path):
    root, start = str(tmp_path), ingest.empty_core(spark)
    row = [("06", 2010, "NEW_CODE", 1.0, "X", "u", "b")]
    filled = ingest.CoreTables(start.geography, start.population, spark.createDataFrame(row, ingest.INDICATOR_SCHEMA))
    ingest.publish_batch(start, ingest.Batch(filled, None, None, ["NEW_CODE"]), root)
    assert ingest.read_core(spark, root).indicators.count() == 1


def test_pooled_backtest_takes_any_period_keys(spark):
    from panelspark.operators.backtest import pooled_backtest

    data = [(y * 100 + m, float(m), 2.0 * m + y) for y in (2020, 2021) for m in range(1, 13)]
    found = pooled_backtest(spark.createDataFrame(data, "period int, x double, v double"), "period", ["x"], "v", 202101)
    assert found.count() == 12


def test_prices_of_any_region(spark):
    from panelspark.plans.features import fallback_index

    prices = spark.createDataFrame([("R5", 2010, "CPI_SHELTER", 7.0), ("US", 2010, "CPI_SHELTER", 1.0)], "geo_code string, year int, indicator_code string, value double")
    regions = spark.createDataFrame([("01", "R5")], "prefix string, region string")
    assert fallback_index(prices, regions).first().index_by_area == {"R5": 7.0, "US": 1.0}


def test_a_stored_trend_model_is_scored_as_a_trend(spark, tmp_path):
    from panelspark.operators.trend import fit_trend
    from panelspark.plans.serve import predict_by_model
    from panelspark.sources.models import load_models, save_models

    features = ["pop_lag1", "unemployment_rate"]
    data = [("06", y, 1000.0 + 20 * (y - 2000), 980.0 + 20 * (y - 2000), 5.0, 1.0) for y in range(2000, 2020)]
    matrix = spark.createDataFrame(data, "geo_code string, year int, population double, pop_lag1 double, unemployment_rate double, rent_cpi_index double")
    save_models(fit_trend(matrix, "geo_code", "year", "population", features), str(tmp_path / "m"), "geo_code")
    found = predict_by_model(matrix, load_models(spark, str(tmp_path / "m")), features, 2015, 2021)
    values = {r.year: (r.yhat, r.kind) for r in found.collect()}
    assert sorted(values) == list(range(2015, 2022)) and values[2020][1] == "future"
    assert all(abs(values[y][0] - (1000 + 20 * (y - 2000))) < 15 for y in range(2015, 2020))
