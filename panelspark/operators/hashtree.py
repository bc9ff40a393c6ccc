"""Fingerprints in two levels: hashes of blocks of periods, and one hash over an entity's blocks.

A leaf covers SPAN periods of one entity, so its list of rows is bounded; the root reads
at most one short hash for each block of the calendar. Stored leaves answer what changed,
and since when, without the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panel import row_text

SPAN = 10
ADDED, CHANGED, REMOVED = "added", "changed", "removed"


def leaf_hashes(df: DataFrame, entity: str, period: str, cols: list[str], *, span: int = SPAN, full: Column | None = None) -> DataFrame:
    """(entity, block, leaf, rows, full_rows): md5 of each block's rows in period order.

    A block is named by its first period. ``full`` marks complete rows, which are counted
    beside all rows; without it every row is complete. Rows without a period form a block
    of their own, with a null name. Rows of equal periods are ordered by their text.
    """
    row = F.struct(F.col(period).alias("p"), row_text(df, cols).alias("t"))
    lines = F.transform(F.sort_array(F.collect_list(row)), lambda r: r["t"])
    block = (F.floor(F.col(period) / span) * span).cast("int").alias("block")
    complete = F.count_if(full) if full is not None else F.count(F.lit(1))
    return df.groupBy(entity, block).agg(
        F.md5(F.array_join(lines, "\n")).alias("leaf"), F.count(F.lit(1)).alias("rows"), complete.alias("full_rows")
    )


def root_hashes(leaves: DataFrame, entity: str, name: str = "data_hash") -> DataFrame:
    """(entity, hash, rows, full_rows): md5 over ``block:leaf`` lines in block order."""
    line = F.struct("block", F.concat_ws(":", F.coalesce(F.col("block").cast("string"), F.lit("")), "leaf").alias("t"))
    lines = F.transform(F.sort_array(F.collect_list(line)), lambda r: r["t"])
    return leaves.groupBy(entity).agg(
        F.md5(F.array_join(lines, "\n")).alias(name), F.sum("rows").alias("rows"), F.sum("full_rows").alias("full_rows")
    )


def drifted_blocks(live: DataFrame, known: DataFrame, entity: str) -> DataFrame:
    """(entity, block, drift) of the blocks whose leaves differ from the known ones."""
    old = known.select(F.col(entity).alias("_entity"), F.col("block").alias("_block"), F.col("leaf").alias("_leaf"))
    same = F.col(entity).eqNullSafe(F.col("_entity")) & F.col("block").eqNullSafe(F.col("_block"))
    drift = F.when(F.col("_leaf").isNull(), ADDED).when(F.col("leaf").isNull(), REMOVED).when(F.col("leaf") != F.col("_leaf"), CHANGED)
    both = live.select(entity, "block", "leaf").join(old, same, "full").withColumn("drift", drift).filter(F.col("drift").isNotNull())
    gone = F.col("drift") == REMOVED
    return both.select(
        F.when(gone, F.col("_entity")).otherwise(F.col(entity)).alias(entity),
        F.when(gone, F.col("_block")).otherwise(F.col("block")).alias("block"),
        "drift",
    )
