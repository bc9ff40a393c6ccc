import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators.forecast import predict, predict_known, roll_forward
from panelspark.operators.trees import evaluate, fit_trees, grow, tree_nodes
from panelspark.sources.models import load_models, save_models

FEATURES = ["pop_lag1", "pop_lag5", "unemployment_rate", "rent_cpi_index"]


def best_split(x, rows, residual, features):
    best = (0.0, None, None)
    total = sum(residual[r] for r in rows)
    for f in range(features):
        values = sorted({x[r][f] for r in rows})
        for low, high in zip(values, values[1:]):
            left = [r for r in rows if x[r][f] <= low]
            s = sum(residual[r] for r in left)
            n, m = len(left), len(rows)
            gain = s * s / (n + 1) + (total - s) ** 2 / (m - n + 1) - total * total / (m + 1)
            if gain > best[0] * (1 + 1e-9) + 1e-9:
                best = (gain, f, low + (high - low) / 2)
    return best


def plain(x, y, rounds, depth, rate):
    """Predictions of boosting written with lists and recursion."""
    base = sum(y) / len(y)
    out = [base] * len(y)

    def split(rows, level, residual):
        _, f, threshold = best_split(x, rows, residual, len(x[0])) if level < depth else (0, None, None)
        if f is None:
            for r in rows:
                out[r] += rate * sum(residual[q] for q in rows) / (len(rows) + 1)
            return
        split([r for r in rows if x[r][f] < threshold], level + 1, residual)
        split([r for r in rows if x[r][f] >= threshold], level + 1, residual)

    for _ in range(rounds):
        residual = [a - b for a, b in zip(y, out)]
        split(list(range(len(y))), 0, residual)
    return out


def panel(seed=1, areas=7):
    rng = random.Random(seed)
    rows = []
    for area in range(areas):
        level = rng.uniform(50, 5000)
        for year in range(1990, 1990 + rng.randrange(3, 25)):
            level *= rng.uniform(0.9, 1.2)
            rows.append((f"a{area}", year, level, rng.choice([None, level * 0.9]), level * rng.choice([0.5, 0.8]), float(rng.randrange(3, 8)), rng.uniform(90, 120)))
    return rows + [("one", 2000, 5.0, 1.0, 1.0, 1.0, 1.0), (None, 2000, 5.0, 1.0, 1.0, 1.0, 1.0), ("no target", 2000, None, 1.0, 1.0, 1.0, 1.0)]


@pytest.fixture
def rows_of(spark):
    return spark.createDataFrame(panel(), "geo_code string, year int, population double, " + ", ".join(f"{f} double" for f in FEATURES))


def test_trees_against_plain_boosting(spark, rows_of):
    models = fit_trees(rows_of, "geo_code", "year", FEATURES, "population", rounds=6, depth=3, rate=0.3, row_share=1, feature_share=1)
    found = {(r.geo_code, r.year): r.yhat for r in predict_known(rows_of, models, "geo_code", "year", FEATURES).collect()}
    by_area = {}
    for area, year, y, *x in panel():
        if area is not None and y is not None:
            by_area.setdefault(area, []).append((year, y, [v or 0.0 for v in x]))
    assert len({a for a, _ in found}) == len(by_area)
    for area, own in by_area.items():
        expected = plain([x for *_, x in own], [y for _, y, _ in own], 6, 3, 0.3)
        for (year, *_), value in zip(own, expected):
            assert found[(area, year)] == pytest.approx(value, rel=1e-9)


def test_fit_does_not_depend_on_the_batch(spark, rows_of):
    fit = lambda df: {r.geo_code: (r.intercept, r.trees) for r in fit_trees(df, "geo_code", "year", FEATURES, "population", rounds=9).collect()}
    whole, alone = fit(rows_of.repartition(1)), fit(rows_of.filter("geo_code = 'a3'"))
    assert whole["a3"] == alone["a3"]
    assert len(whole["a3"][1]) == 9


def test_more_rounds_fit_better():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3, 40, 2))
    y = np.sin(x[:, :, 0]) + x[:, :, 1] ** 2
    errors = []
    for rounds in (1, 20, 200):
        known = np.ones((3, 40), bool)
        base, *parts = grow(x, y, known, np.arange(3), np.tile(np.arange(40), (3, 1)), rounds=rounds, depth=4, rate=0.05, row_share=0.9, feature_share=0.9)
        again = np.stack([evaluate(x[:, i], base, *parts) for i in range(40)], axis=1)
        errors.append(((again - y) ** 2).mean())
    assert errors[0] > errors[1] > errors[2] and errors[2] < 0.05 * errors[0]


def test_stored_trees_serve_and_show_their_nodes(spark, rows_of, tmp_path):
    models = fit_trees(rows_of, "geo_code", "year", FEATURES, "population", rounds=4)
    save_models(models, str(tmp_path), "geo_code")
    stored = load_models(spark, str(tmp_path), ["xgb"])
    turned = FEATURES[::-1]  # columns are found by name
    a = predict_known(rows_of, models, "geo_code", "year", FEATURES).collect()
    b = predict_known(rows_of, stored, "geo_code", "year", turned).collect()
    assert sorted((r.geo_code, r.year, r.yhat) for r in a) == sorted((r.geo_code, r.year, r.yhat) for r in b)

    nodes = tree_nodes(stored, "geo_code").collect()
    table = {(r.geo_code, r.tree, r.node): r for r in nodes}
    base = {r.geo_code: r.intercept for r in stored.collect()}
    for row, r in zip(rows_of.filter("geo_code = 'a2'").orderBy("year").collect(), sorted((r for r in a if r.geo_code == "a2"), key=lambda r: r.year)):
        total = base["a2"]
        for tree in range(4):
            node = 0
            while table["a2", tree, node].feature is not None:
                at = table["a2", tree, node]
                node = at.left if (row[at.feature] or 0.0) < at.threshold else at.right
            total += table["a2", tree, node].leaf
        assert r.yhat == pytest.approx(total, rel=1e-12)


def test_roll_forward_mixes_trees_and_coefficients(spark, rows_of):
    trees = fit_trees(rows_of.filter("geo_code < 'a4'"), "geo_code", "year", FEATURES, "population", rounds=5)
    line = rows_of.filter("geo_code in ('a5', 'a6')").select("geo_code").distinct().select(
        "geo_code",
        F.lit("linear").alias("model"),
        F.array(*map(F.lit, FEATURES)).alias("features"),
        F.array(*[F.lit(float(k)) for k in (1, 0, 0, 0)]).alias("coef"),
        F.lit(7.0).alias("intercept"),
        F.lit(False).alias("use_delta"),
        F.lit(None).cast(trees.schema["trees"].dataType).alias("trees"),
    )
    both = trees.drop("train_rows").unionByName(line)
    rolled = roll_forward(rows_of, both, "geo_code", "year", FEATURES, end=2020).collect()
    single = roll_forward(rows_of, trees, "geo_code", "year", FEATURES, end=2020).collect()
    plain_line = roll_forward(rows_of, line.drop("trees"), "geo_code", "year", FEATURES, end=2020).collect()
    assert sorted(map(tuple, rolled)) == sorted(map(tuple, [*single, *plain_line]))
    kinds = {r.kind for r in predict(rows_of, both, "geo_code", "year", FEATURES, 1990, 2020).collect()}
    assert kinds == {"covered", "future"}


def test_missing_features_are_an_error(spark, rows_of):
    models = fit_trees(rows_of, "geo_code", "year", FEATURES, "population", rounds=1)
    with pytest.raises(Exception, match="does not have the features"):
        predict_known(rows_of, models, "geo_code", "year", FEATURES[:3]).collect()
