"""Mixing sources to target weights with integer block quotas."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from .tables import query, read
from .words import WORD

#: Words of a block.
BLOCK = 16
#: Documents of a shard; a source has at most MOST_SHARDS, so larger sources have larger shards.
SHARD, MOST_SHARDS = 1000, 4096
#: A mix names a weight for each source, so there must be few; more are refused.
MOST_SOURCES = 100_000
#: How often a word may be taken.
REPEATS = 3


def capped_targets(weights: Sequence[float], sizes: Sequence[float], repeats: float = REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, each at most ``repeats`` times its size.

    What a cap cuts off is shared again by weight among the others until none is above.
    """
    weight, cap = np.asarray(weights, float), repeats * np.asarray(sizes, float)
    target, free = np.zeros(len(weight)), np.ones(len(weight), bool)
    while free.any():
        left = float(np.sum(sizes)) - cap[~free].sum()
        share = left * weight / weight[free].sum()
        over = free & (share > cap)
        if not over.any():
            target[free] = share[free]
            break
        target[over] = cap[over]
        free &= ~over
    return target.tolist()


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int] | None = None) -> np.ndarray:
    """Seats by the highest quotients votes / (2 * seats so far + 1); ties go to the first.

    ``most`` limits the seats of each; what it holds back goes to the next quotients.
    Binary search finds the last quotient that wins, so the time does not depend on
    the number of seats.
    """
    votes = np.asarray(votes, float)
    most = np.full(len(votes), seats) if most is None else np.asarray(most)
    most = np.where(votes > 0, most, 0).astype(np.int64)
    seats = int(min(seats, most.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)

    def won(quotient: float) -> np.ndarray:
        """Seats whose quotient is above the given one."""
        return np.minimum(np.maximum(np.ceil((votes / quotient - 1) / 2), 0), most).astype(np.int64)

    low, high = 0.0, float(votes.max())
    for _ in range(200):
        middle = (low + high) / 2
        if middle <= low or middle >= high:
            break
        if won(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = won(high)
    while (left := seats - int(given.sum())) > 0:  # equal quotients at the border
        quotient = np.where(given < most, votes / (2 * given + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")
        best = best[quotient[best] >= quotient[best[0]] * (1 - 1e-12)][:left]
        given[best] += 1
    return given


def _coprime(n: int, draw: random.Random) -> int:
    """A seeded number without a common factor with n."""
    while True:
        step = draw.randrange(1, max(2, n))
        if math.gcd(step, n) == 1 or n == 0:
            return step


def _shard_quotas(block: int, repeats: int, seed: int):
    def run(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard").reset_index(drop=True)
        blocks = -(-shards["words"] // block)
        quota = sainte_lague(shards["words"], int(shards["blocks_wanted"].iloc[0]), repeats * blocks)
        draws = [random.Random(f"{seed} {c} {s}") for c, s in zip(shards["code"], shards["shard"])]
        step = [_coprime(int(n), d) for n, d in zip(blocks, draws)]
        shift = [d.randrange(max(1, int(n))) for n, d in zip(blocks, draws)]
        return shards[["code", "shard"]].assign(blocks=blocks, quota=quota, step=step, shift=shift)

    return run


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    repeats: int = REPEATS,
    seed: int = 7,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row for each document: id, size, source, source_size, target, taken.

    ``size`` counts words (null text: 0), ``target`` is what the mix should take from
    the document's source: sources by code point, null last, have the given weights in
    turn and share the size of all. ``taken`` words of the document are in the mix,
    repeats counted, at most ``repeats`` times its size.

    Each source is a row of blocks of ``block`` words. Sainte-Lague gives whole blocks
    to sources by target, then within a source to its shards by size (a shard is a
    hash bucket of ids). A shard of n blocks takes each of them quota // n times and a
    seeded choice of quota % n once more, by a permutation of the block numbers, so
    no block is a row and nothing is sorted but ids within a shard. A document takes
    what the blocks that it lies in are taken.

    Equal rows are separate documents; a null id is one like others; an empty table
    gives no rows; of other columns those named by ``carry`` are kept (with ``_``
    behind a name that the result has already). Carried columns are read again for the last step and never stored. The driver
    holds a row for each source, and refuses more than MOST_SOURCES.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    named = docs.select(F.col(id_col), F.col(source_col).alias("source"), size.alias("size"), F.struct(*carry).alias("rest"))
    sized = stored(named.drop("rest"), "sizes")
    known = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    known = known.limit(MOST_SOURCES + 1).collect()
    if len(known) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    known.sort(key=lambda r: (r.source is None, r.source or ""))  # Python orders text by code point
    given = [weights[i % len(weights)] for i in range(len(known))]
    target = capped_targets(given, [r.size for r in known], repeats)
    wanted = sainte_lague(target, round(sum(target) / block))
    shards = [max(1, min(MOST_SHARDS, math.ceil(r.n / SHARD))) for r in known]
    sources = spark.createDataFrame(
        [(r.source, i, r.size, t, int(b), s) for i, (r, t, b, s) in enumerate(zip(known, target, wanted, shards))],
        "source string, code int, source_size long, target double, blocks_wanted long, n_shards int",
    )
    sources = sources.withColumnRenamed("source", "s")

    def dealt(rows: DataFrame) -> DataFrame:
        own = rows.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        return own.withColumn("shard", F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)), "n_shards"))

    own = dealt(named if carry else sized)
    quotas = dealt(sized).groupBy("code", "shard", "blocks_wanted").agg(F.sum("size").alias("words"))
    quotas = quotas.groupBy("code").applyInPandas(
        _shard_quotas(block, repeats, seed), "code int, shard long, blocks long, quota long, step long, shift long"
    )
    along = Window.partitionBy("code", "shard").orderBy(id_col, "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = own.withColumn("end", F.sum("size").over(along)).join(quotas, ["code", "shard"])
    placed = placed.withColumn("begin", F.col("end") - F.col("size"))
    # block i is chosen if (i * step + shift) mod blocks < quota mod blocks
    once_more = F.expr(
        f"""aggregate(sequence(begin div {block}, (end - 1) div {block}), 0L, (n, i) -> n + if(
            (i * step + shift) % blocks < quota % blocks,
            least(end, (i + 1) * {block}) - greatest(begin, i * {block}), 0L))"""
    )
    taken = F.when(F.col("size") > 0, F.expr("size * (quota div blocks)") + once_more).otherwise(F.lit(0))
    names = [id_col, "size", "source", "source_size", "target", "taken"]
    rest = [F.col("rest")[c].alias(_free(c, names)) for c in carry]
    return placed.withColumn("taken", taken.cast("long")).select(*names, *rest)


def _free(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


@query("op1_source_mixing")
def op1(spark, folder):
    return mix(read(spark, folder, "documents"))
