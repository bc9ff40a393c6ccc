"""Whole ingest jobs: raw rows, calls, order of landing, rules, features; and means across runs."""

import json

import pytest

from panelspark.plans import ingest, refresh
from panelspark.plans.refresh import FACT_SCHEMA, read_matrix
from panelspark.plans.features import matrix_from_facts
from panelspark.session import fresh_dir
from panelspark.sources import buckets, documents, snapshots
from panelspark.sources.audit import record_calls
from panelspark.sources.buckets import read_buckets
from panelspark.streaming.landing import ingest_landed


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(buckets, "BUCKETS", 8)
    monkeypatch.setattr(refresh, "BUCKETS", 8)


def series_doc(data):
    series = [{"seriesID": k, "data": [{"year": y, "period": p, "value": v} for y, p, v in points]} for k, points in data.items()]
    return json.dumps({"status": "REQUEST_SUCCEEDED", "Results": {"series": series}})


def table_doc(*rows):
    return json.dumps([["NAME", "B01001_001E", "state"], *rows])


def land(spark, path, docs, mode="append"):
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode(mode).text(path)


def test_two_batches_with_a_duplicate_a_bad_row_and_a_revised_value(spark, rows):
    root = fresh_dir(spark, "core")
    years = range(2008, 2015)

    def run(batch, docs):
        path = fresh_dir(spark, "land")
        for year, doc in docs:
            land(spark, f"{path}/survey=acs1/level=state/year={year}", [doc])
        found, _ = documents.table_rows(documents.read_documents(spark, path, origin=True), "state")
        before = ingest.read_core(spark, root)
        ingest.publish_batch(before, ingest.load_surveys(before, None, found, batch), root)

    first = [(y, table_doc(["A", "1", "06"], ["A", str(1000 + y), "06"], ["B", "-5", "36"])) for y in years]
    for _ in range(2):  # the second run of a batch changes nothing
        run("b1", first)
    assert rows(ingest.read_core(spark, root).population) == [("06", y, 1000 + y) for y in years]
    raw = spark.read.parquet(f"{root}/raw/survey_rows")
    assert raw.count() == 2 * len(years) and raw.filter("geo_code = '06' and population = 1").count() == len(years)

    unrate = spark.createDataFrame([(f"LASST06{'0' * 12}3", y, "M13", "5.0") for y in years], "series_id string, year int, period string, value string")
    before = ingest.read_core(spark, root)
    ingest.publish_batch(before, ingest.load_unemployment(before, unrate, "b2"), root)
    prices = spark.createDataFrame([("CUUR0000SAH1", f"{y}-05-01", "100") for y in years], "series_id string, obs_date string, raw_value string").selectExpr("series_id", "cast(obs_date as date) obs_date", "raw_value")
    before = ingest.read_core(spark, root)
    ingest.publish_batch(before, ingest.load_prices(before, prices, "b3"), root)
    run("b4", [(2014, table_doc(["A", "7", "06"]))])

    assert rows(ingest.read_core(spark, root).population.filter("year = 2014")) == [("06", 2014, 7)]
    known = read_buckets(spark, f"{root}/features/facts", FACT_SCHEMA)
    matrix = read_matrix(spark, f"{root}/features")
    assert sorted(map(tuple, matrix.collect())) == sorted(map(tuple, matrix_from_facts(known, known).collect()))
    assert matrix.filter("geo_code = '06' and year = 2014 and population = 7").count() == 1
    assert spark.read.parquet(f"{root}/raw/survey_rows").count() == 2 * len(years) + 1


def test_baseline_follows_the_rules(spark, rows):
    root = fresh_dir(spark, "core")
    people = spark.createDataFrame([("US", 2010, 5), ("US", 3000, 6), ("06", 2010, 7)], "geo_code string, year int, population bigint")
    docs = spark.createDataFrame([(series_doc({"LNS1": [("2020", "M01", "500")], "LNS2": [("2021", "M01", "4.5")]}),)], "doc string")
    before = ingest.read_core(spark, root)
    ingest.publish_batch(before, ingest.load_baseline(before, people, docs, "b"), root)
    core = ingest.read_core(spark, root)
    assert rows(core.population) == [("US", 2010, 5)]
    assert rows(core.indicators, "year", "indicator_code", "value") == [(2010, "ACS_TOTAL_POP", 5.0), (2021, "BLS_UNRATE", 4.5)]
    bad = spark.read.parquet(f"{root}/quarantine/baseline-b")
    assert sorted((r.year, r.broken_rules[0]) for r in bad.collect()) == [(2020, "rate_is_percent"), (3000, "year_in_calendar")]


@pytest.mark.parametrize("parts", [1, 3])
def test_months_of_one_year_over_several_runs(spark, rows, parts):
    landing, core, checkpoint = (fresh_dir(spark, n) for n in ("land", "core", "check"))
    state, later = f"LASST06{'0' * 12}3", f"LASST36{'0' * 12}3"
    points = [("2020", f"M{m:02d}", str(m)) for m in range(1, 13)]
    for k in range(parts):
        docs = {state: points[k::parts]}
        if k == parts - 1:
            docs[later] = [("2020", "M01", "9"), ("2020", "M13", "4")]
        else:
            docs[later] = [("2020", "M02", "8")]
        land(spark, landing, [series_doc(docs)])
        ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    version = snapshots.current_version(spark, f"{core}/indicators/BLS_UNRATE")
    found = rows(ingest.read_core(spark, core).indicators, "geo_code", "year", "value")
    assert found == [("06", 2020, 6.5), ("36", 2020, 4.0)]
    ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    assert snapshots.current_version(spark, f"{core}/indicators/BLS_UNRATE") == version
    land(spark, landing, [series_doc({state: points[:2]})])  # known points once more
    ingest_landed(spark, landing, core, checkpoint, batch_prefix="b")
    assert rows(ingest.read_core(spark, core).indicators, "geo_code", "year", "value") == found


def test_calls_are_logged_once(spark):
    path = fresh_dir(spark, "calls")
    schema = "etl_batch_id string, requested_at string, endpoint string, params map<string,string>, payload map<string,string>, http_status int, response_json string, notes string"

    def calls(batch, pages):
        data = [(batch, f"2024-01-0{1 + k}", "https://api/x", {"page": str(p), "api_key": f"secret{k}"}, None, 200, "{}", None) for k, p in enumerate(pages)]
        return spark.createDataFrame(data, schema)

    assert record_calls(spark, path, calls("b1", [1, 2, 2])) == 2
    assert record_calls(spark, path, calls("b1", [1, 2, 2])) == 0
    assert record_calls(spark, path, calls("b2", [2, 3])) == 1
    log = spark.read.parquet(path)
    assert log.count() == 3 and "secret" not in str(log.collect())


def test_number_of_a_writer_that_died_is_free_again(spark, monkeypatch):
    root = fresh_dir(spark, "snap")
    snapshots.claim(spark, root, 1)
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.claim(spark, root, 1)
    monkeypatch.setattr(snapshots, "STALE", 0)
    snapshots.claim(spark, root, 1)
