"""Hashes of blocks of periods: roots, drift, and leaves kept beside the refreshed matrix."""

import hashlib

from pyspark.sql import functions as F

from panelspark.operators.hashtree import drifted_blocks, leaf_hashes, root_hashes
from panelspark.operators.registry import drift_todo
from panelspark.plans import training
from panelspark.plans.features import HASHED_COLUMNS, REGRESSORS
from panelspark.plans.refresh import apply_facts, read_leaves, read_matrix
from panelspark.session import fresh_dir
from panelspark.sources import buckets

from .test_refresh import facts, few_buckets, frame  # noqa: F401

PANEL = "e string, t int, v double"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_leaves_and_roots_by_hand(spark):
    rows = [("a", 2003, 1.5), ("a", 2001, None), ("a", 2010, 2.0), ("a", None, 7.0), ("b", -1, 0.0), ("b", -1, 0.0), (None, 2000, 1.0)]
    leaves = leaf_hashes(spark.createDataFrame(rows, PANEL), "e", "t", ["t", "v"], full=F.col("v").isNotNull())
    found = {(r.e, r.block): (r.leaf, r.rows, r.full_rows) for r in leaves.collect()}
    assert found == {
        ("a", 2000): (md5("2001|__NA__\n2003|1.500000"), 2, 1),
        ("a", 2010): (md5("2010|2.000000"), 1, 1),
        ("a", None): (md5("__NA__|7.000000"), 1, 1),
        ("b", -10): (md5("-1|0.000000\n-1|0.000000"), 2, 2),
        (None, 2000): (md5("2000|1.000000"), 1, 1),
    }
    roots = {r.e: (r.data_hash, r.rows, r.full_rows) for r in root_hashes(leaves, "e").collect()}
    lines = [f":{found['a', None][0]}", f"2000:{found['a', 2000][0]}", f"2010:{found['a', 2010][0]}"]
    assert roots["a"] == (md5("\n".join(lines)), 4, 3) and set(roots) == {"a", "b", None}
    shuffled = leaf_hashes(spark.createDataFrame(rows[::-1], PANEL), "e", "t", ["t", "v"])
    assert drifted_blocks(leaves, shuffled, "e").count() == 0


def test_drift_names_blocks_and_empty_tables(spark):
    none = leaf_hashes(spark.createDataFrame([], PANEL), "e", "t", ["v"])
    assert none.count() == 0 and root_hashes(none, "e").count() == 0 and drifted_blocks(none, none, "e").count() == 0
    old = spark.createDataFrame([("a", 2000, 1.0), ("a", 2011, 1.0), ("a", 2022, 1.0), (None, None, 1.0)], PANEL)
    new = spark.createDataFrame([("a", 2000, 1.0), ("a", 2011, 2.0), ("b", 2000, 1.0), (None, None, 2.0)], PANEL)
    live, known = (leaf_hashes(x, "e", "t", ["t", "v"]) for x in (new, old))
    found = {(r.e, r.block, r.drift) for r in drifted_blocks(live, known, "e").collect()}
    assert found == {("a", 2010, "changed"), ("a", 2020, "removed"), ("b", 2000, "added"), (None, None, "changed")}


def whole(spark, root):
    leaves = leaf_hashes(read_matrix(spark, root), "geo_code", "year", HASHED_COLUMNS, full=F.col("has_full_features"))
    return sorted(map(tuple, leaves.collect()))


def test_leaves_follow_the_matrix_and_other_buckets_keep_theirs(spark, frame):  # noqa: F811
    root = fresh_dir(spark, "features")
    apply_facts(spark, root, frame(facts()))
    assert sorted(map(tuple, read_leaves(spark, root).collect())) == whole(spark, root)
    before = buckets.current_folders(spark, f"{root}/leaves")[1]
    old = root_hashes(read_leaves(spark, root), "geo_code")
    pointers = spark.createDataFrame([(r.geo_code, "ridge", r.data_hash) for r in old.collect()], "geo_code string, model string, data_hash string")
    written = apply_facts(spark, root, frame([("48001", 2012, "population", 12345.0)]))
    after = buckets.current_folders(spark, f"{root}/leaves")[1]
    assert {b for b in after if after[b] != before.get(b)} == set(written)
    assert sorted(map(tuple, read_leaves(spark, root).collect())) == whole(spark, root)
    todo = drift_todo(root_hashes(read_leaves(spark, root), "geo_code"), pointers, ["ridge"])
    assert [r.geo_code for r in todo.collect()] == ["48001"]
    plan = training.training_plan(read_matrix(spark, root), pointers, ["ridge"], min_years=1, leaves=read_leaves(spark, root))
    assert [r.geo_code for r in plan.collect()] == ["48001"] and "pop_lag5" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_a_matrix_without_leaves_gets_them_all(spark, frame, monkeypatch):  # noqa: F811
    from panelspark.plans import refresh

    root = fresh_dir(spark, "features")
    with monkeypatch.context() as m:
        m.setattr(refresh, "publish_leaves", lambda *_: None)
        apply_facts(spark, root, frame(facts()))
    assert read_leaves(spark, root).count() == 0
    apply_facts(spark, root, frame([("48001", 2012, "population", 12345.0)]))
    assert sorted(map(tuple, read_leaves(spark, root).collect())) == whole(spark, root)


def test_training_reads_only_areas_that_are_due(spark, frame):  # noqa: F811
    root = fresh_dir(spark, "features")
    apply_facts(spark, root, frame(facts()))
    leaves, matrix = read_leaves(spark, root), read_matrix(spark, root)
    people = matrix.select("geo_code", "year", "population")
    job = fresh_dir(spark, "job")
    options = {"models": ["ridge"], "min_years": 3, "split": 2015, "horizon": 2}
    count = training.record_training(job, matrix, people, REGRESSORS, leaves=leaves, **options)
    assert count == matrix.filter("has_full_features").groupBy("geo_code").count().filter("count >= 3").count() > 0
    assert training.record_training(job, matrix, people, REGRESSORS, leaves=leaves, **options) == 0
