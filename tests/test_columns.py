from pyspark.sql import functions as F

from panelspark.functions import codes
from panelspark.functions.guarded import (
    clamp,
    compound_growth_pct,
    date_or_null,
    growth_pct,
    integer_or_null,
    iso_utc,
    number_or_null,
)


def one(df):
    return df.first()[0]


def test_growth_needs_a_base_other_than_zero(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None)], "v double, b double")
    assert [r[0] for r in df.select(growth_pct(F.col("v"), F.col("b"))).collect()] == [10.0, None, None]
    grown = df.select(compound_growth_pct(F.col("v"), F.col("b"), 2)).collect()
    assert abs(grown[0][0] - 4.880884817) < 1e-6 and grown[1][0] is None and grown[2][0] is None


def test_region_of_states_counties_and_others(spark, rows):
    df = spark.createDataFrame([(c,) for c in ["09", "17001", "48", "06037", "72", "US", "R1", "6"]], "c string")
    found = dict(rows(df.select("c", codes.region_of(F.col("c")))))
    assert found == {"09": "R1", "17001": "R2", "48": "R3", "06037": "R4", "72": None, "US": None, "R1": None, "6": None}
    assert len(codes.STATE_CODES) == 52 and len(set(codes.STATE_CODES)) == 52


def test_series_ids_round_trip(spark, rows):
    df = spark.createDataFrame([("06",), ("06037",), ("US",)], "c string")
    ids = df.select("c", codes.series_id_for(F.col("c")).alias("s"))
    assert rows(ids) == [("06", "LASST060000000000003"), ("06037", "LAUCN060370000000003"), ("US", None)]
    back = ids.select("c", codes.series_area_code(F.col("s")), codes.series_area_type(F.col("s")))
    assert rows(back) == [("06", "06", "state"), ("06037", "06037", "county"), ("US", None, None)]


def test_casts_give_null_instead_of_errors(spark):
    df = spark.createDataFrame([(".",), ("4.5",), ("x",), (None,), (" 7 ",)], "t string")
    assert [r[0] for r in df.select(number_or_null(F.col("t"))).collect()] == [None, 4.5, None, None, 7.0]
    assert [r[0] for r in df.select(integer_or_null(F.col("t"))).collect()][2] is None
    dates = spark.createDataFrame([("2020-02-30",), ("2020-02-28",)], "t string").select(date_or_null(F.col("t")))
    assert [str(r[0]) for r in dates.collect()] == ["None", "2020-02-28"]


def test_choices_and_names(spark, rows):
    df = spark.createDataFrame([("US", "06", "06037"), ("US", "06", ""), ("", None, None)], "n string, s string, c string")
    assert [r[0] for r in df.select(codes.chosen_area(F.col("n"), F.col("s"), F.col("c"))).collect()] == ["06037", "06", "US"]
    names = spark.createDataFrame([("XGB",), (None,), ("tree",)], "m string").select(codes.model_name(F.col("m")))
    assert [r[0] for r in names.collect()] == ["xgb", "linear", None]
    stems = spark.createDataFrame([("10",), ("linear_10",), ("prophet_model_10",)], "s string")
    parts = stems.select(codes.artifact_model(F.col("s"), F.lit("ridge")), codes.artifact_area(F.col("s")))
    assert [tuple(r) for r in parts.collect()] == [("ridge", "10"), ("linear", "10"), ("prophet", "10")]


def test_times_and_clamp(spark):
    df = spark.sql("select timestamp'2024-05-06 07:08:09' as t, 20.0D as v")
    assert one(df.select(iso_utc(F.col("t")))) == "2024-05-06T07:08:09Z"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        noon = spark.sql("select timestamp'2024-01-06 12:00:00Z' as t")
        assert one(noon.select(iso_utc(F.col("t")))) == "2024-01-06T12:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(df.select(clamp(F.col("v"), 2.0, 15.0))) == 15.0
