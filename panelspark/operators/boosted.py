"""One boosted-tree model for all entities, on growth instead of levels."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- Fixed values: tree settings -------------------------------------------
MAX_DEPTH = 4
ROUNDS = 200
LEARNING_RATE = 0.05
ROW_SHARE = 0.9
COLUMN_SHARE = "0.9"
SEED = 42
# -----------------------------------------------------------------------------


def _scaled(df: DataFrame, features: list[str], lag: str) -> DataFrame:
    """Level features relative to the lag, so entities of any size share one model."""
    base = F.nullif(F.col(lag), F.lit(0.0))
    levels = {c: F.col(c) / base for c in features if c.startswith("pop_lag")}
    known = df.filter(base.isNotNull()).dropna(subset=features)
    inputs = {f"in_{c}": levels.get(c, F.col(c).cast("double")) for c in features if c != lag}
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="inputs")
    return assembler.transform(known.withColumns(inputs)).drop(*inputs)


def fit_boosted(
    train: DataFrame, features: list[str], target: str = "population", lag: str = "pop_lag1", rounds: int = ROUNDS
) -> Model:
    """Trees grow level by level over all rows of the cluster; the target is the
    ratio to the previous value."""
    rows = _scaled(train, features, lag).withColumn("ratio", F.col(target) / F.col(lag)).filter(F.col("ratio").isNotNull())
    trees = GBTRegressor(
        featuresCol="inputs",
        labelCol="ratio",
        predictionCol="ratio_hat",
        maxDepth=MAX_DEPTH,
        maxIter=rounds,
        stepSize=LEARNING_RATE,
        subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=COLUMN_SHARE,
        seed=SEED,
    )
    return trees.fit(rows)


def score_boosted(df: DataFrame, model: Model, features: list[str], lag: str = "pop_lag1") -> DataFrame:
    scored = model.transform(_scaled(df, features, lag))
    return scored.withColumn("yhat", F.col("ratio_hat") * F.col(lag)).drop("inputs", "ratio_hat")
