import hashlib
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.operators import panel as p
from panelspark.operators import quality as q
from panelspark.operators.annual import annual_preferred, choose_canonical
from panelspark.operators.metrics import as_metric_rows, forecast_metrics, regression_metrics
from panelspark.operators.ranking import chunked, top_per_group, with_row_number
from panelspark.plans.features import feature_matrix

PANEL = "e string, t int, v double"


def test_lags_by_row_and_by_value_differ_in_gaps(spark, rows):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0)], PANEL)
    by_row = p.with_lags(df, "e", "t", "v", {1: "lag"})
    by_value = p.with_lags_by_value(df, "e", "t", "v", {1: "lag"})
    assert rows(by_row, "t", "lag") == [(1, None), (2, 1.0), (4, 2.0)]
    assert rows(by_value, "t", "lag") == [(1, None), (2, 1.0), (4, None)]


def test_fills(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 2.0), ("a", 3, None), ("a", 4, 6.0)], PANEL)
    assert rows(p.fill_neighbours(df, "e", "t", ["v"]), "t", "v") == [(1, 2.0), (2, 2.0), (3, 2.0), (4, 6.0)]
    assert rows(p.fill_mean(df, "e", ["v"]), "t", "v") == [(1, 4.0), (2, 2.0), (3, 4.0), (4, 6.0)]
    assert rows(p.last_known(df, "e", "t", ["v"])) == [("a", 6.0)]


def test_recent_stats_of_short_and_flat_histories(spark, rows):
    df = spark.createDataFrame([("one", 1, 5.0)] + [("flat", t, 3.0) for t in range(9)] + [("up", t, 2.0**t) for t in range(9)], PANEL)
    found = {r["e"]: r for r in p.recent_stats(df, "e", "t", "v", 5).collect()}
    assert (found["one"]["cagr"], found["one"]["step_mean"], found["one"]["step_std"]) == (0.0, 0.0, 0.0)
    assert (found["flat"]["cagr"], found["flat"]["step_std"], found["flat"]["n_values"]) == (0.0, 0.0, 6)
    assert found["up"]["cagr"] == pytest.approx(1.0) and found["up"]["step_mean"] == pytest.approx((256 - 8) / 5)


def test_fingerprint_ignores_row_order_and_marks_nulls(spark):
    data = [("a", t, float(t) if t % 2 else None) for t in range(6)]
    shuffled = random.Random(1).sample(data, len(data))
    prints = [p.fingerprint(spark.createDataFrame(d, PANEL), "e", "t", ["t", "v"]).first()["data_hash"] for d in (data, shuffled)]
    text = "\n".join(f"{t}|{t}.000000" if t % 2 else f"{t}|__NA__" for t in range(6))
    assert prints == [hashlib.md5(text.encode()).hexdigest()] * 2
    none = p.fingerprint(spark.createDataFrame([], PANEL), "e", "t", ["t", "v"])
    both = p.fingerprint_or_empty(spark.createDataFrame([("z",)], "e string"), none, "e")
    assert both.first()["data_hash"] == hashlib.md5(b"EMPTY").hexdigest()


def test_training_frame_imputes_medians_and_keeps_entities_without_lags(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1.0, None, 5.0), ("a", 2, 2.0, 1.0, None), ("a", 3, 3.0, 2.0, 7.0), ("a", 4, None, 3.0, 9.0), ("b", 1, 1.0, None, 1.0)],
        "e string, t int, y double, pop_lag1 double, x double",
    )
    assert rows(p.training_frame(df, "e", ["x"], "y"), "e", "t", "x") == [("a", 2, 8.0), ("a", 3, 7.0), ("b", 1, 1.0)]


def test_align_reports_missing_and_drops_extra(spark):
    df = spark.createDataFrame([("a", 1, 2)], "e string, x int, other int")
    assert p.align(df, ["z"], ["e"], {"x": "z"}).columns == ["e", "z"]
    with pytest.raises(ValueError, match="missing features: \\['q'\\]"):
        p.align(df, ["x", "q"], ["e"])


def test_usable_features_need_three_values(spark):
    df = spark.createDataFrame([("a", 1, 1.0, None), ("a", 2, 1.0, 1.0), ("a", 3, 1.0, 1.0)], "e string, t int, x double, y double")
    assert p.usable_features(df, "e", ["x", "y"]).first()["features"] == ["x"]
    assert p.numeric_columns(df, ["t"]) == ["x", "y"]


def _core(spark, years, unmapped=False):
    areas = ["72"] if unmapped else ["06", "US"]
    people = [(a, y, 100 + y) for a in areas for y in years]
    rates = [(a, y, "BLS_UNRATE", 5.0) for a in areas for y in years]
    prices = [("US", y, "CPI_SHELTER", 1.0) for y in years] + [("R4", y, "CPI_SHELTER", 2.0) for y in years]
    return (
        spark.createDataFrame(people, "geo_code string, year int, population bigint"),
        spark.createDataFrame(rates + prices, "geo_code string, year int, indicator_code string, value double"),
    )


def test_feature_matrix_fallbacks_and_cut_in(spark, rows):
    people, indicators = _core(spark, range(1999, 2010))
    found = rows(feature_matrix(people, indicators), "geo_code", "year", "rent_cpi_index", "pop_lag5")
    assert [r[:2] for r in found] == [(a, y) for a in ("06", "US") for y in range(2005, 2010)]
    assert {(r[0], r[2]) for r in found} == {("06", 2.0), ("US", 1.0)}
    late = feature_matrix(people, indicators.filter("indicator_code = 'CPI_SHELTER' or year >= 2007"))
    assert sorted({r[1] for r in rows(late, "geo_code", "year")}) == [2007, 2008, 2009]


def test_unmapped_area_uses_the_nation_and_zero_lag_is_incomplete(spark, rows):
    people, indicators = _core(spark, range(2000, 2011), unmapped=True)
    assert {r[0] for r in rows(feature_matrix(people, indicators), "rent_cpi_index")} == {1.0}
    zero = people.withColumn("population", F.when(F.col("year") == 2001, 0).otherwise(F.col("population")))
    assert 2006 not in {r[0] for r in rows(feature_matrix(zero, indicators), "year")}
    assert feature_matrix(people.limit(0), indicators).count() == 0


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_split_ranking_equals_plain_window(spark, hot):
    rng = random.Random(3)
    data = [("hot" if rng.random() < hot else f"g{rng.randrange(40)}", rng.choice([None, rng.randrange(20)]), i) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v int, i int")
    keys = [F.col("v").isNull(), F.coalesce("v", F.lit(0)), F.col("i")]
    expected = df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(F.struct(*[k.alias(f"x{j}") for j, k in enumerate(keys)]))))
    found = with_row_number(df, ["g"], keys, "n", smallest_split=200)
    assert found.exceptAll(expected).count() == 0 and found.count() == len(data)


def test_ranks_are_one_lazy_plan_and_include_null_groups(spark):
    data = [(None if i % 3 == 0 else i % 2, (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(data, "g int, v int")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "no job while planning")
    ranked = with_row_number(df, ["g"], [F.col("v")], "n", smallest_split=50)
    assert list(jobs.getJobIdsForGroup("ranks")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = {(r.g, r.v): r.n for r in ranked.collect()}
    for g in (None, 0, 1):
        values = sorted(v for k, v in data if k == g)
        assert [found[g, v] for v in values] == list(range(1, len(values) + 1))


def test_chunks_follow_the_total_order(spark):
    df = spark.range(1234).withColumn("k", F.format_string("%05d", (F.col("id") * 37) % 1234))
    numbered = chunked(df, ["k"], 50, "chunk")
    sizes = numbered.groupBy("chunk").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("chunk").collect()
    assert [r["n"] for r in sizes] == [50] * 24 + [34]
    assert all(a["hi"] < b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_top_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = top_per_group(df, ["g"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_annual_values_are_preferred_per_series(spark, rows):
    points = [
        ("m", "2000", "M01", "1"), ("m", "2000", "M02", "3"), ("m", "2001", "M01", "."),
        ("a", "2000", "M01", "1"), ("a", "2000", "M13", "9"), ("a", "2001", "M01", "4"),
    ]
    found = annual_preferred(spark.createDataFrame(points, "series_id string, year string, period string, value string"))
    assert rows(found) == [("a", 2000, 9.0), ("m", 2000, 2.0), ("m", 2001, None)]


def test_canonical_source(spark, rows):
    data = [("06", "state", 2020, s) for s in ("ACS1", "ACS5")] + [("06037", "county", 2020, s) for s in ("ACS1", "ACS5")] + [("07", "state", 2020, "ACS5")]
    df = spark.createDataFrame(data, "geo_code string, geo_type string, year int, source string")
    assert rows(choose_canonical(df), "geo_code", "source") == [("06", "ACS1"), ("06037", "ACS5"), ("07", "ACS5")]


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame(
        [("flat", 5.0, 5.0), ("flat", 5.0, 5.0), ("off", 5.0, 6.0), ("off", 5.0, 5.0), ("one", 1.0, 2.0), ("neg", -10.0, -9.0), ("neg", 0.0, 1.0), ("none", None, 1.0)],
        "m string, actual double, yhat double",
    )
    found = {r["m"]: r for r in forecast_metrics(df, ["m"]).collect()}
    assert found["flat"]["r2"] == 1.0 and found["off"]["r2"] == 0.0 and found["one"]["r2"] is None
    assert found["neg"]["mape"] == pytest.approx(-10.0) and "none" not in found
    assert {r["m"]: r["mape"] for r in regression_metrics(df, ["m"]).collect()}["neg"] == pytest.approx(10.0)
    long = as_metric_rows(forecast_metrics(df, ["m"]), ["m"], "test").filter("m = 'one'").collect()
    assert sorted(r["metric"] for r in long) == ["mae", "mape", "rmse"] and {r["fold"] for r in long} == {-1}


def test_rules_split_and_count(spark, rows):
    df = spark.createDataFrame([("a", 2000, 5), ("b", 1800, -1), ("c", 2000, None)], "geo_code string, year int, population bigint")
    good, bad = q.split_by_rules(df, q.POPULATION_RULES)
    assert rows(good, "geo_code") == [("a",), ("c",)]
    assert bad.first()["broken_rules"] == ["population_not_negative", "year_in_calendar"]
    assert rows(q.rule_violations(df, q.POPULATION_RULES)) == [("population_not_negative", 1), ("year_in_calendar", 1)]


def test_report_of_an_empty_batch(spark):
    df = spark.createDataFrame([], "geo_code string, year int, value double")
    report = q.validation_report(df, "bls", "value", "rate", "geo_code").first()
    assert (report["rows"], report["geos"], report["year_min"], report["issues"]) == (0, 0, None, ["no rows"])


def test_orphans(spark, rows):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert rows(q.orphan_keys(child, parent, "k")) == [("b", 2)]
