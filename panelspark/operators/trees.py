"""Boosted regression trees of each entity, fitted for many entities at a time.

An entity's rows are bounded by the calendar, so they travel as one row; a batch of
entities is fitted together, one array operation for each level of each tree. A model is
a row like any other stored model: its trees are arrays in heap order, where the
children of node i are 2i + 1 and 2i + 2 and a feature of -1 marks a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosted import LEARNING_RATE, MAX_DEPTH, ROUNDS, ROW_SHARE, SEED

# ---- Fixed values: tree settings ----------------------------------------------
FEATURE_SHARE = 0.9
LEAF_PENALTY = 1.0
LEAST_ROWS = 1  # of a leaf
# ---------------------------------------------------------------------------------

TREE_MODEL = "xgb"
TREES = T.ArrayType(
    T.StructType(
        [
            T.StructField("feature", T.ArrayType(T.IntegerType())),
            T.StructField("threshold", T.ArrayType(T.DoubleType())),
            T.StructField("leaf", T.ArrayType(T.DoubleType())),
        ]
    )
)
#: Gains below this share of an entity's squared residuals are rounding.
NOISE = 1e-12
#: Elements of the largest work array.
WORK = 1 << 22


def _uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the parts alone, not on what else a batch holds."""
    x = np.uint64(0)
    with np.errstate(over="ignore"):
        for part in parts:
            x = (x ^ np.asarray(part).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            x = x ^ (x >> np.uint64(32))
    return x.astype(np.float64) / 2.0**64


def grow(
    x: np.ndarray,
    y: np.ndarray,
    known: np.ndarray,
    keys: np.ndarray,
    periods: np.ndarray,
    *,
    rounds: int,
    depth: int,
    rate: float,
    row_share: float,
    feature_share: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(base, feature, threshold, leaf) for entities x rows x features; the last three are entities x trees x nodes.

    Squared error, exact splits half way between neighbours, leaves shrunk by
    LEAF_PENALTY. Of equal gains the first feature, then the lowest threshold counts.
    """
    many, rows, features = x.shape
    nodes = 2 ** (depth + 1) - 1
    entity = np.arange(many)[:, None]
    # one after the other, so that rows filled up for longer neighbours change nothing
    added = lambda values: np.cumsum(values, axis=1)[:, -1]
    base = added(np.where(known, y, 0)) / np.maximum(known.sum(1), 1)
    residual = np.where(known, y - base[:, None], 0.0)
    order = np.argsort(np.where(known[:, :, None], x, np.inf), axis=1, kind="stable")
    ordered = np.take_along_axis(x, order, axis=1)
    all_feature = np.full((many, rounds, nodes), -1, np.int32)
    all_threshold, all_leaf = np.zeros((many, rounds, nodes)), np.zeros((many, rounds, nodes))
    used = max(1, int(feature_share * features))
    for tree in range(rounds):
        chosen = known & (_uniform(keys[:, None], periods, tree, SEED) < row_share) if row_share < 1 else known
        chosen = np.where(chosen.any(1, keepdims=True), chosen, known)
        luck = _uniform(keys[:, None], np.arange(features), tree, SEED + 1)
        open_ = np.argsort(np.argsort(luck, axis=1, kind="stable"), axis=1) < used
        node = np.zeros((many, rows), np.int64)  # within its level; -1 once it ends in a leaf
        heap = np.zeros((many, rows), np.int64)
        for level in range(depth + 1):
            width, first = 2**level, 2**level - 1
            member = (node[:, :, None] == np.arange(width)) & chosen[:, :, None]
            total = added(member * residual[:, :, None])
            count = member.sum(1)
            all_leaf[:, tree, first : first + width] = np.where(count > 0, rate * total / (count + LEAF_PENALTY), 0.0)
            if level == depth:
                break
            best = np.full((many, width), 0.0)
            feature, threshold = np.full((many, width), -1, np.int32), np.zeros((many, width))
            floor = NOISE * added(residual**2)[:, None] + 1e-300
            for f in range(features):
                own = order[:, :, f]
                here = np.take_along_axis(member, own[:, :, None], axis=1)
                left_sum = np.cumsum(here * residual[entity, own][:, :, None], axis=1)
                left = np.cumsum(here, axis=1)
                right, right_sum = count[:, None] - left, total[:, None] - left_sum
                value = ordered[:, :, f]
                # the next value of the node to the right
                after = np.where(here, value[:, :, None], np.inf)
                after = np.minimum.accumulate(after[:, ::-1], axis=1)[:, ::-1]
                after = np.concatenate([after[:, 1:], np.full((many, 1, width), np.inf)], axis=1)
                gain = left_sum**2 / (left + LEAF_PENALTY) + right_sum**2 / (right + LEAF_PENALTY) - (total**2 / (count + LEAF_PENALTY))[:, None]
                fits = here & (left >= LEAST_ROWS) & (right >= LEAST_ROWS) & (after > value[:, :, None]) & open_[:, None, f, None]
                gain = np.where(fits, gain, -np.inf)
                at = gain.argmax(axis=1)
                top = np.take_along_axis(gain, at[:, None], axis=1)[:, 0]
                better = top > np.maximum(best * (1 + 1e-12), floor)
                low = np.take_along_axis(value, at, axis=1)
                high = np.take_along_axis(after, at[:, None], axis=1)[:, 0]
                best, feature = np.where(better, top, best), np.where(better, f, feature)
                with np.errstate(invalid="ignore"):
                    threshold = np.where(better, low + (high - low) / 2, threshold)
            all_feature[:, tree, first : first + width] = feature
            all_threshold[:, tree, first : first + width] = threshold
            inside = node >= 0
            at = np.where(inside, node, 0)
            split = np.where(inside, np.take_along_axis(feature, at, axis=1), -1)
            over = np.take_along_axis(x, np.maximum(split, 0)[:, :, None], axis=2)[:, :, 0] >= np.take_along_axis(threshold, at, axis=1)
            goes = split >= 0
            heap = np.where(goes, 2 * heap + 1 + over, heap)
            node = np.where(goes, 2 * node + over, -1)
        residual = np.where(known, residual - np.take_along_axis(all_leaf[:, tree], heap, axis=1), 0.0)
    return base, all_feature, all_threshold, all_leaf


def evaluate(x: np.ndarray, base: np.ndarray, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Predictions of entities x features from entities x trees x nodes, level by level."""
    at = np.zeros(feature.shape[:2], np.int64)[:, :, None]
    for _ in range(int(np.log2(feature.shape[2] + 1)) - 1):
        split = np.take_along_axis(feature, at, axis=2)
        value = np.take_along_axis(x[:, None, :], np.maximum(split, 0), axis=2)
        over = value >= np.take_along_axis(threshold, at, axis=2)
        at = np.where(split >= 0, 2 * at + 1 + over, at)
    return base + np.take_along_axis(leaf, at, axis=2)[:, :, 0].sum(1)


def fit_trees(
    train: DataFrame,
    entity: str,
    period: str,
    features: Sequence[str],
    target: str,
    *,
    rounds: int = ROUNDS,
    depth: int = MAX_DEPTH,
    rate: float = LEARNING_RATE,
    row_share: float = ROW_SHARE,
    feature_share: float = FEATURE_SHARE,
) -> DataFrame:
    """(entity, model, features, coef, intercept, use_delta, train_rows, trees) for each entity with a target.

    Missing features count as zero. Each tree sees a share of the rows and features,
    drawn by entity, period and tree, so a fit repeats itself wherever it runs.
    """
    rows = F.struct(
        F.col(period).cast("long").alias("p"),
        F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]).alias("x"),
        F.col(target).cast("double").alias("y"),
    )
    known = train.filter(F.col(target).isNotNull() & F.col(entity).isNotNull())
    # one row for each entity, as long as its calendar
    packed = known.groupBy(entity).agg(F.sort_array(F.collect_list(rows)).alias("rows")).withColumn("key", F.xxhash64(F.col(entity).cast("string")))
    fields = [("model", T.StringType()), ("features", T.ArrayType(T.StringType())), ("coef", T.ArrayType(T.DoubleType()))]
    fields += [("intercept", T.DoubleType()), ("use_delta", T.BooleanType()), ("train_rows", T.LongType()), ("trees", TREES)]
    schema = T.StructType([packed.schema[entity], *(T.StructField(n, k) for n, k in fields)])
    options = {"rounds": rounds, "depth": depth, "rate": rate, "row_share": row_share, "feature_share": feature_share}

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            longest = max(map(len, batch["rows"]), default=1)
            some = max(1, WORK // (longest * 2**depth))
            for a in range(0, len(batch), some):
                yield _fit_batch(batch.iloc[a : a + some], entity, list(features), options)

    return packed.mapInPandas(fit, schema)


def _fit_batch(batch: pd.DataFrame, entity: str, features: list[str], options: dict) -> pd.DataFrame:
    count = np.array([len(r) for r in batch["rows"]])
    shape = (len(batch), int(count.max()))
    known = np.arange(shape[1]) < count[:, None]
    x, y, periods = np.zeros((*shape, len(features))), np.zeros(shape), np.zeros(shape, np.int64)
    flat = [r for rows in batch["rows"] for r in rows]
    x[known] = np.array([r["x"] for r in flat]).reshape(len(flat), len(features))
    y[known] = [r["y"] for r in flat]
    periods[known] = [r["p"] for r in flat]
    base, feature, threshold, leaf = grow(x, y, known, batch["key"].to_numpy(), periods, **options)
    trees = [
        [{"feature": f, "threshold": t, "leaf": v} for f, t, v in zip(*own)]
        for own in zip(feature.tolist(), threshold.tolist(), leaf.tolist())
    ]
    many = len(batch)
    return pd.DataFrame(
        {
            entity: batch[entity].to_numpy(),
            "model": TREE_MODEL,
            "features": [features] * many,
            "coef": [None] * many,
            "intercept": base,
            "use_delta": False,
            "train_rows": count,
            "trees": trees,
        }
    )


def tree_nodes(models: DataFrame, *keys: str) -> DataFrame:
    """The nodes of stored trees that a prediction can reach: (keys, tree, node, feature, threshold, left, right, leaf)."""
    trees = models.filter(F.col("trees").isNotNull()).select(*keys, "features", F.posexplode("trees").alias("tree", "t"))
    parts = F.arrays_zip(F.col("t.feature").alias("f"), F.col("t.threshold").alias("threshold"), F.col("t.leaf").alias("leaf"))
    each = trees.select(*keys, "features", "tree", "t", F.posexplode(parts).alias("node", "n"))
    parent = F.floor((F.col("node") - 1) / 2).cast("int")
    inner = F.col("n.f") >= 0
    reached = (F.col("node") == 0) | (F.get("t.feature", parent) >= 0)
    return each.filter(reached).select(
        *keys,
        "tree",
        "node",
        F.when(inner, F.get("features", F.col("n.f"))).alias("feature"),
        F.when(inner, F.col("n.threshold")).alias("threshold"),
        F.when(inner, 2 * F.col("node") + 1).alias("left"),
        F.when(inner, 2 * F.col("node") + 2).alias("right"),
        F.when(~inner, F.col("n.leaf")).alias("leaf"),
    )


def tree_score(inputs: Column) -> Column:
    """Prediction of a row joined with its model, from the values in the model's order of features."""
    levels = F.round(F.log2(F.size(F.get("trees", F.lit(0))["feature"]) + 1)).cast("int") - 1

    def leaf(values: Column, tree: Column) -> Column:
        def down(node: Column, _: Column) -> Column:
            split = F.get(tree["feature"], node)
            under = F.get(values, split) < F.get(tree["threshold"], node)
            return F.when(split < 0, node).when(under, 2 * node + 1).otherwise(2 * node + 2)

        return F.get(tree["leaf"], F.aggregate(F.sequence(F.lit(1), levels), F.lit(0), down))

    # the values go along with the sum, so that they are made once for a row
    start = F.struct(inputs.alias("x"), F.lit(0.0).alias("sum"))
    add = lambda so_far, tree: F.struct(so_far["x"].alias("x"), (so_far["sum"] + leaf(so_far["x"], tree)).alias("sum"))
    return F.col("intercept") + F.aggregate("trees", start, add, lambda end: end["sum"])
