"""JSON columns as Variant: faults, paths, types, shapes, storage."""

from pyspark.sql import functions as F

from panelspark.plans.training import run_settings
from panelspark.session import stored
from panelspark.sources import variants as v

DOCS = "id long, params string, env string, malformed_note string"


def test_faults_paths_and_types(spark):
    rows = [
        (1, '{"alpha": 1.5, "features": ["a", "b"], "deep": {"x": [10, 20]}}', "{}", "n"),
        (2, '{"alpha": "text", "features": []}', "{", None),
        (3, None, "null", ""),
        (4, "", '"text"', "n"),
        (4, "[1, 2]", "12", "n"),
    ]
    df = stored(v.parsed(spark.createDataFrame(rows, DOCS), "params", "env"), "variants")
    wanted = {"alpha": ("$.alpha", "double"), "features": ("$.features", "array<string>"), "x": ("$.deep.x[1]", "int"), "none": ("$.none", "string")}
    found = v.fields(df, "params", wanted).orderBy("id", F.size("malformed").desc()).collect()
    assert [(r.alpha, r.features, r.x, r.none) for r in found] == [(1.5, ["a", "b"], 20, None), (None, [], None, None)] + [(None,) * 4] * 3
    assert [r.malformed for r in found] == [[], ["env"], [], ["params"], []]
    again = {r.env for r in v.texts(df, "params", "env").collect()}
    assert again == {"{}", None, "null", '"text"', "12"}
    assert dict(df.dtypes)["params"] == "variant"


def test_shapes_merge_documents(spark):
    rows = [(1, '{"k": 1}', None, "a"), (2, '{"k": 2, "s": "x"}', None, "a"), (3, "[1.5]", None, "b"), (4, None, None, "c"), (5, "nope", None, "c")]
    df = v.parsed(spark.createDataFrame(rows, DOCS), "params")
    found = {r.malformed_note: (r.shape, r.documents) for r in v.shapes(df, "params", ["malformed_note"]).collect()}
    assert found == {"a": ("OBJECT<k: BIGINT, s: STRING>", 2), "b": ("ARRAY<DECIMAL(2,1)>", 1), "c": ("VOID", 0)}
    assert v.shapes(df.limit(0), "params", ["malformed_note"]).count() == 0


def test_settings_of_recorded_runs(spark):
    runs = spark.createDataFrame([("r1", '{"features":["a","b"],"alpha":1.0}'), ("r2", '{"features":["a"]}'), ("r3", None)], "run_id string, params string")
    found = {r.run_id: (r.used_features, r.alpha) for r in run_settings(runs).collect()}
    assert found == {"r1": (["a", "b"], 1.0), "r2": (["a"], None), "r3": (None, None)}
