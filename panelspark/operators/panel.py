"""Panels: one row per (entity, period), and windows over them.

``build_panel`` aggregates, so its result has unique keys, and periods come
from a closed calendar. A window over one entity therefore sees at most
``PERIODS_PER_YEAR * (LAST_YEAR - FIRST_YEAR + 1)`` rows, however many raw rows
the entity has: raw rows are combined before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1900, 2100
PERIODS_PER_YEAR = 12


def build_panel(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggregates.items()])


def by_entity(entity: str, period: str):
    return W.partitionBy(entity).orderBy(period)


def with_lags(df: DataFrame, entity: str, period: str, value: str, names: dict[int, str]) -> DataFrame:
    """Row-based lags: the n-th preceding row, whatever its period."""
    w = by_entity(entity, period)
    return df.withColumns({name: F.lag(value, n).over(w) for n, name in names.items()})


def with_lags_by_value(df: DataFrame, entity: str, period: str, value: str, names: dict[int, str]) -> DataFrame:
    """Value-based lags: the row whose period is exactly n lower, NULL in a gap."""
    w = by_entity(entity, period)
    return df.withColumns({name: F.first(value).over(w.rangeBetween(-n, -n)) for n, name in names.items()})


def with_moving_average(df: DataFrame, entity: str, period: str, value: str, rows: int, name: str) -> DataFrame:
    w = by_entity(entity, period).rowsBetween(1 - rows, 0)
    return df.withColumn(name, F.avg(value).over(w))


def fill_neighbours(df: DataFrame, entity: str, period: str, cols: list[str]) -> DataFrame:
    """Carry the last known value forward, then the first known one back."""
    running = (W.unboundedPreceding, 0)
    before = by_entity(entity, period).rowsBetween(*running)
    after = W.partitionBy(entity).orderBy(F.desc(period)).rowsBetween(*running)
    return df.withColumns({c: F.coalesce(*[F.last(c, ignorenulls=True).over(w) for w in (before, after)]) for c in cols})


def fill_mean(df: DataFrame, entity: str, cols: list[str]) -> DataFrame:
    w = W.partitionBy(entity)
    return df.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(w)) for c in cols})


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.fillna(0.0, subset=cols)


def last_known(df: DataFrame, entity: str, period: str, cols: list[str]) -> DataFrame:
    """Latest non-null value of each column per entity, combined before the shuffle."""
    return df.groupBy(entity).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(period))).alias(c) for c in cols]
    )


def first_full_period(df: DataFrame, entity: str, period: str, flag: str, name: str) -> DataFrame:
    return df.groupBy(entity).agg(F.min(F.when(F.col(flag), F.col(period))).alias(name))


def cut_in(df: DataFrame, entity: str, period: str, flag: str, floor: int) -> DataFrame:
    """Complete rows from the later of ``floor`` and the entity's first complete period."""
    first = F.min(F.when(F.col(flag), F.col(period))).over(W.partitionBy(entity))
    return (
        df.withColumn("_first", first)
        .filter(F.col(flag) & (F.col(period) >= F.greatest(F.lit(floor), F.col("_first"))))
        .drop("_first")
    )


def densify(df: DataFrame, entity: str, period: str, start: int, end: int, within: list[str] | None = None) -> DataFrame:
    """One row per entity and period of [start, end]; values are NULL in gaps."""
    keys = [entity, *(within or [])]
    spine = df.select(*keys).distinct().withColumn(period, F.explode(F.sequence(F.lit(start), F.lit(end))))
    return spine.join(df, [*keys, period], "left")


def recent_stats(df: DataFrame, entity: str, period: str, value: str, lookback: int) -> DataFrame:
    """Growth rate, and mean and population deviation of first differences, over
    the last ``lookback + 1`` known values of each entity."""
    newest = W.partitionBy(entity).orderBy(F.desc(period))
    tail = (
        df.filter(F.col(value).isNotNull())
        .withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= lookback + 1)
        .withColumn("_step", F.col(value) - F.lag(value).over(by_entity(entity, period)))
    )
    first, last = F.min_by(value, period), F.max_by(value, period)
    steps = F.count(value) - 1
    growth = F.when((steps > 0) & (first > 0), F.pow(last / first, F.lit(1.0) / F.nullif(steps, F.lit(0))) - 1.0)
    return tail.groupBy(entity).agg(
        F.count(value).alias("n_values"),
        F.coalesce(growth, F.lit(0.0)).alias("cagr"),
        F.coalesce(F.avg("_step"), F.lit(0.0)).alias("step_mean"),
        F.coalesce(F.stddev_pop("_step"), F.lit(0.0)).alias("step_std"),
    )


def row_text(df: DataFrame, cols: list[str], scale: int = 6) -> Column:
    """The columns of a row joined by ``|``, nulls marked.

    Fractions become decimals, since engines print doubles differently.
    """
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    texts = [
        F.coalesce((F.col(c).cast(f"decimal(38,{scale})") if c in numeric else F.col(c)).cast("string"), F.lit("__NA__"))
        for c in cols
    ]
    return F.concat_ws("|", *texts)


def fingerprint(df: DataFrame, entity: str, period: str, cols: list[str], scale: int = 6, name: str = "data_hash") -> DataFrame:
    """md5 of an entity's rows in period order: columns joined by ``|``, rows by a newline."""
    row = F.struct(F.col(period).alias("p"), row_text(df, cols, scale).alias("t"))
    rows = F.transform(F.sort_array(F.collect_list(row)), lambda r: r["t"])
    return df.groupBy(entity).agg(F.md5(F.array_join(rows, "\n")).alias(name))


EMPTY_FINGERPRINT_TEXT = "EMPTY"


def fingerprint_or_empty(entities: DataFrame, prints: DataFrame, entity: str, name: str = "data_hash") -> DataFrame:
    """Fingerprint of every listed entity; those without rows get the empty one."""
    return entities.select(entity).distinct().join(prints, entity, "left").withColumn(
        name, F.coalesce(name, F.md5(F.lit(EMPTY_FINGERPRINT_TEXT)))
    )


def numeric_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    kinds = {"byte", "short", "integer", "long", "float", "double", "decimal"}
    return [f.name for f in df.schema if f.name not in exclude and f.dataType.typeName() in kinds]


def usable_features(df: DataFrame, entity: str, cols: list[str], at_least: int = 3) -> DataFrame:
    """Per entity, the features with enough known values."""
    known = [F.when(F.count(c) >= at_least, F.lit(c)) for c in cols]
    return df.groupBy(entity).agg(F.array_compact(F.array(*known)).alias("features"))


def training_frame(df: DataFrame, entity: str, features: list[str], target: str, lag: str | None = "pop_lag1") -> DataFrame:
    """Rows with a known lag (all rows of an entity that has none), features as
    doubles with gaps filled by the entity's median, known targets only."""
    per_entity = W.partitionBy(entity)
    if lag in df.columns:
        has_lag = F.max(F.col(lag).isNotNull()).over(per_entity)
        df = df.withColumn("_lagged", has_lag).filter(~F.col("_lagged") | F.col(lag).isNotNull()).drop("_lagged")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.median(c).over(per_entity)) for c in features}
    return df.withColumns({**filled, target: F.col(target).cast("double")}).filter(F.col(target).isNotNull())


def align(df: DataFrame, order: list[str], keep: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Columns in the order a model expects. Missing ones are an error, others are dropped."""
    renamed = df.withColumnsRenamed(rename or {})
    missing, extra = feature_gap(renamed.columns, order, keep)
    if missing:
        raise ValueError(f"missing features: {missing}; not used: {extra}")
    return renamed.select(*keep, *[F.col(c).cast("double").alias(c) for c in order])


def feature_gap(available: list[str], wanted: list[str], keep: list[str]) -> tuple[list[str], list[str]]:
    missing = [c for c in wanted if c not in available]
    extra = [c for c in available if c not in wanted and c not in keep]
    return missing, extra


def union_all(frames: list[DataFrame], relaxed: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=relaxed), frames)
