"""Keyed merges of one DataFrame into another.

The result is a new DataFrame; publish it with ``sources.snapshots``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import top_per_group


def one_per_key(df: DataFrame, keys: list[str], order: str | None, last: bool) -> DataFrame:
    """One row per key: the last (or first) by ``order``, any one without it."""
    if order is None:
        return df.dropDuplicates(keys)
    return top_per_group(df, keys, [F.desc(order) if last else F.asc(order)])


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    *,
    order: str | None = None,
    update_cols: list[str] | None = None,
    on_conflict: str = "update",
) -> DataFrame:
    """Insert new keys; on existing keys update ``update_cols`` or ignore.

    Both sides are reduced to a marker struct, so a NULL in the update replaces
    the old value, and presence never depends on a column's own NULLs.
    """
    if on_conflict not in ("update", "ignore"):
        raise ValueError(f"unknown conflict policy: {on_conflict}")
    payload = [c for c in target.columns if c not in keys]
    changed = set(payload if update_cols is None else update_cols) if on_conflict == "update" else set()

    incoming = one_per_key(updates, keys, order, last=on_conflict == "update")
    types = dict(target.dtypes)

    def new_value(c: str) -> Column:
        value = F.col(c) if c in incoming.columns else F.lit(None)
        return value.cast(types[c]).alias(c)

    old = target.select(*keys, F.struct(*payload).alias("_old"))
    new = incoming.select(*keys, F.struct(*[new_value(c) for c in payload]).alias("_new"))
    merged = old.join(new, keys, "full_outer")
    existed, arrived = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def chosen(c: str) -> Column:
        take_new = arrived if c in changed else ~existed
        return F.when(take_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    return merged.select(*keys, *[chosen(c) for c in payload]).select(*target.columns)


def append_if_absent(target: DataFrame, rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows to append: the first per key among those whose key is not stored yet."""
    return one_per_key(rows, keys, order, last=False).join(target.select(*keys), keys, "left_anti").select(*target.columns)


def update_from(target: DataFrame, source: DataFrame, keys: list[str], assign: dict[str, str]) -> DataFrame:
    """Set target columns from matching source rows; other rows stay as they are.

    ``assign`` maps target columns to source columns. Source keys are unique.
    """
    values = F.struct(*[F.col(src).alias(dst) for dst, src in assign.items()])
    joined = target.join(source.select(*keys, values.alias("_new")), keys, "left")
    matched = F.col("_new").isNotNull()
    cols = [
        F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in assign else F.col(c)
        for c in target.columns
    ]
    return joined.select(*cols)
