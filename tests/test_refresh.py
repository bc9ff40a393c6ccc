import os
import random

import pytest
from pyspark.sql import functions as F

from panelspark.plans import refresh
from panelspark.plans.features import matrix_from_facts
from panelspark.plans.refresh import FACT_SCHEMA, apply_facts, read_matrix
from panelspark.session import fresh_dir
from panelspark.sources import buckets, snapshots


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(buckets, "BUCKETS", 8)
    monkeypatch.setattr(refresh, "BUCKETS", 8)


def facts(seed=0):
    rng = random.Random(seed)
    out = []
    for area in ["US", "06", "06001", "06003", "36", "36001", "48", "48001", "72", "R1"]:
        for year in range(2003, 2020):
            if rng.random() < 0.9 and area != "R1":
                out.append((area, year, "population", float(rng.randrange(1000, 9000))))
                out.append((area, year, "BLS_UNRATE", float(rng.randrange(2, 9))))
    for area in ("US", "R1", "R2", "R4", "06"):
        out += [(area, year, "CPI_SHELTER", 100.0 + year - 2000 + rng.random()) for year in range(2003, 2020)]
    return out


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/matrix/data") for f in names if f.endswith(".parquet")}


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, FACT_SCHEMA)


def recomputed(spark, root):
    known = buckets.read_buckets(spark, f"{root}/facts", FACT_SCHEMA)
    return sorted(map(tuple, matrix_from_facts(known, known).collect()))


def test_batches_give_the_full_matrix(spark, frame):
    root, rows = fresh_dir(spark, "features"), facts()
    rng = random.Random(1)
    rng.shuffle(rows)
    for part in (rows[:250], rows[250:], [("R1", 2010, "CPI_SHELTER", 1.0)], [("US", 2011, "CPI_SHELTER", 2.0), ("06001", 2005, "population", 7.0)]):
        apply_facts(spark, root, frame(part))
        assert sorted(map(tuple, read_matrix(spark, root).collect())) == recomputed(spark, root)
    assert read_matrix(spark, root).count() > 50


def test_untouched_buckets_keep_their_files(spark, frame):
    root = fresh_dir(spark, "features")
    apply_facts(spark, root, frame(facts()))
    before = files(root)
    year = read_matrix(spark, root, ["48001"]).agg(F.max("year")).first()[0]
    written = apply_facts(spark, root, frame([("48001", year, "population", 12345.0)]))
    assert written == buckets.touched(frame([("48001", 0, "", 0.0)]))
    after = files(root)
    assert before < after and all(f"bucket={written[0]}/" in f for f in after - before)
    assert apply_facts(spark, root, frame([("48001", year, "population", 12345.0)])) == []
    assert files(root) == after
    found = read_matrix(spark, root, ["48001"]).filter(F.col("year") == year).first()
    assert found.population == 12345.0
    assert sorted(map(tuple, read_matrix(spark, root).collect())) == recomputed(spark, root)


def test_regional_prices_reach_the_areas_that_fall_back(spark, frame):
    root = fresh_dir(spark, "features")
    apply_facts(spark, root, frame(facts()))
    written = apply_facts(spark, root, frame([("R4", 2015, "CPI_SHELTER", 55.0)]))
    assert buckets.touched(frame([("06001", 0, "", 0.0)]))[0] in written
    value = {r.geo_code: r.rent_cpi_index for r in read_matrix(spark, root).filter("year = 2015").collect()}
    assert value.get("06001") == 55.0 and value.get("06") != 55.0


def test_a_small_merge_reads_only_its_buckets(spark, frame):
    root = fresh_dir(spark, "facts")
    buckets.merge_buckets(spark, root, frame(facts()), ["geo_code", "year", "indicator_code"], FACT_SCHEMA)
    one = buckets.touched(frame([("36", 0, "", 0.0)]))
    read = buckets.read_buckets(spark, root, FACT_SCHEMA, one)
    assert len(read.inputFiles()) < len(buckets.read_buckets(spark, root, FACT_SCHEMA).inputFiles())
    changed = buckets.merge_buckets(spark, root, frame([("36", 2004, "population", 1.0), ("36", 2030, "population", 2.0)]), ["geo_code", "year", "indicator_code"], FACT_SCHEMA)
    assert {(r.year, r.value) for r in changed.collect()} == {(2004, 1.0), (2030, 2.0)}


def test_two_writers_cannot_take_one_version(spark):
    root = fresh_dir(spark, "snap")
    snapshots.publish(spark.range(3), root)
    snapshots.claim(spark, root, 2)
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.publish(spark.range(5), root)
    assert snapshots.read_snapshot(spark, root).count() == 3


def test_a_damaged_pointer_is_no_empty_table(spark, tmp_path):
    (tmp_path / "pointer").mkdir()
    (tmp_path / "pointer" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        snapshots.read_snapshot(spark, str(tmp_path), spark.range(1).schema)


def test_last_row_of_a_key_counts_by_order(spark):
    root = fresh_dir(spark, "features")
    rows = [("06", 2010, "population", float(v), v) for v in (3, 9, 5)]
    updates = spark.createDataFrame(rows, "geo_code string, year int, indicator_code string, value double, place int")
    apply_facts(spark, root, updates, order="place")
    assert buckets.read_buckets(spark, f"{root}/facts", FACT_SCHEMA).select(F.col("value")).first()[0] == 9.0
