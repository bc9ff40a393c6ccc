"""Embedding near-duplicates by spherical-cap filters with structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import Forest, components
from .tables import query, read

#: Vectors that share a filter by chance, filters that a linked pair shares on average, filters of a vector at least.
CROWD, SHARED, LEAST = 64, 8, 24
#: Vectors compared at once.
TILE = 2048
#: Members of a filter that one task holds; larger filters are cut into parts, compared pair by pair.
MEMBERS = 8192


@dataclass(frozen=True)
class Code:
    """``words`` random directions in each of ``blocks`` slices; a filter is one choice for each slice."""

    blocks: int
    words: int
    cap: float  # a vector is in a filter if their product, times the square root of the dimension, is above

    @classmethod
    def for_size(cls, n: int, cosine: float) -> Code:
        """Caps shrink as the table grows, so that about CROWD vectors meet in a filter by chance."""
        share = min(0.02, CROWD / max(1, n))
        normal = NormalDist()
        cap = normal.inv_cdf(1 - share)
        both = 1 - normal.cdf(cap * (1 - cosine) / (1 - cosine * cosine) ** 0.5)
        filters = SHARED / both / share
        blocks = max(2, int(np.ceil(np.log(filters) / np.log(48))))
        return cls(blocks, int(np.ceil(filters ** (1 / blocks))), cap)

    def directions(self, dimension: int) -> list[np.ndarray]:
        """For each slice of the rotated space, its code words; equal in every task."""
        rng = np.random.default_rng(1000 + dimension)
        turn = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        out = []
        for part in np.array_split(np.arange(dimension), min(self.blocks, dimension)):
            word = rng.standard_normal((self.words, len(part)))
            word *= np.sqrt(len(part)) / np.linalg.norm(word, axis=1, keepdims=True)
            out.append(turn[:, part] @ word.T)
        return out

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that unit vectors exceed.

        The cap is lowered for vectors that exceed fewer than LEAST, as they lie far
        from all code words, and so would vectors near to them.
        """
        # in a few dimensions no product can be larger, so caps are wider there
        cap = np.full(len(vectors), min(self.cap, 0.7 * vectors.shape[1] ** 0.5))
        least = min(LEAST, self.words ** min(self.blocks, vectors.shape[1]) // 4)
        row, number = self.exceeding(vectors, cap)
        few = np.bincount(row, minlength=len(vectors)) < least
        while few.any():
            cap[few] -= 0.2
            some = np.flatnonzero(few)
            again, found = self.exceeding(vectors[some], cap[some])
            others = ~few[row]
            row, number = np.concatenate([row[others], some[again]]), np.concatenate([number[others], found])
            few[some] = np.bincount(again, minlength=len(some)) < least
        return row, number

    def exceeding(self, vectors: np.ndarray, cap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List decoding: choices are extended slice by slice, and dropped once even the best rest stays below the cap."""
        scores = [vectors @ d for d in self.directions(vectors.shape[1])]
        rest = np.cumsum([s.max(axis=1) for s in scores[::-1]], axis=0)[::-1]
        row, total, number = np.arange(len(vectors)), np.zeros(len(vectors)), np.zeros(len(vectors), np.int64)
        for i, score in enumerate(scores):
            later = rest[i + 1] if i + 1 < len(scores) else np.zeros(len(vectors))
            rows, totals, numbers = [], [], []
            for a in range(0, len(row), 65536):
                at = row[a : a + 65536]
                sums = total[a : a + 65536, None] + score[at]
                some, word = np.nonzero(sums + later[at][:, None] >= cap[at][:, None])
                rows.append(at[some])
                totals.append(sums[some, word])
                numbers.append(number[a : a + 65536][some] * self.words + word)
            row, total, number = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, totals, numbers))
        return row, number


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; dividing by the largest component first keeps squares finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def compare(
    filter_id: int,
    node: np.ndarray,
    size: np.ndarray,
    vectors: np.ndarray,
    filters: list[np.ndarray],
    cosine: float,
    part: np.ndarray | None = None,
):
    """Links among the members of one filter that no smaller common filter has: (links of each member, edges).

    Vectors are compared tile by tile; edges join each member to the first one of
    its group, so their number does not grow with the number of pairs. With ``part``,
    only members of different parts are compared.
    """
    n = len(node)
    count, forest = np.zeros(n, np.int64), Forest(n)
    known, number = np.unique(np.concatenate(filters), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(f) for f in filters])
    smaller = known[number] < filter_id
    owner, number = owner[smaller], number[smaller]

    def marks(low: int, high: int, used: np.ndarray) -> np.ndarray:
        out = np.zeros((high - low, len(used)), np.float32)
        some = (owner >= low) & (owner < high)
        at = np.searchsorted(used, number[some])
        fits = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == number[some]) if len(used) else np.zeros(len(at), bool)
        out[owner[some][fits] - low, at[fits]] = 1
        return out

    for a in range(0, n, TILE):
        for b in range(a, n, TILE):
            close = vectors[a : a + TILE] @ vectors[b : b + TILE].T >= cosine
            if part is not None:
                close &= part[a : a + TILE, None] != part[b : b + TILE]
            elif a == b:
                np.fill_diagonal(close, False)
            if a == b:
                close = np.triu(close)
            if not close.any():
                continue
            i, j = np.nonzero(close)
            x, y = np.unique(i), np.unique(j)
            # filters below this one that members of linked pairs have on both sides
            used = np.intersect1d(np.unique(number[np.isin(owner, x + a)]), np.unique(number[np.isin(owner, y + b)]))
            if len(used):
                before = marks(a, min(n, a + TILE), used)[x] @ marks(b, min(n, b + TILE), used)[y].T > 0
                new = ~before[np.searchsorted(x, i), np.searchsorted(y, j)]
                i, j = i[new], j[new]
            np.add.at(count, i + a, size[j + b])
            np.add.at(count, j + b, size[i + a])
            forest.join(i + a, j + b)
    member = np.flatnonzero(forest.label != np.arange(n))
    return count, node[forest.label[member]], node[member]


def near_vectors(
    table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95
) -> DataFrame:
    """One row for each vector: id, n_links, component_id, kept.

    Two vectors of one length link if their cosine in double precision is ``cosine``
    or more. Equal vectors are one class with a count and cost nothing. Each class
    goes to all filters of a product code whose direction it exceeds; a task compares
    the members of a filter exactly and counts a link only in the smallest filter that
    both have, so no pair is a row. A link is missed only if the two share no filter,
    which the cap makes rare (they share SHARED on average at the threshold).

    Null vectors, empty ones, zero, and those with null or non-finite components link
    with nothing. A null id keeps its row, counts as a vector and names no component
    with another id; repeated rows are vectors of their own; an empty table gives no
    rows; other columns are ignored.
    """
    vector = F.col("vector")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vector", lambda x: x != 0)
    own = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    own = own.withColumn("vector", F.when(fine, vector))
    classes = own.where("vector is not null").groupBy("vector").agg(F.count("*").alias("size"), F.min("id").alias("least"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    code = Code.for_size(classes.count(), cosine)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.array([len(v) for v in batch.column(2)], np.int64)
            for d in np.unique(length):
                rows = np.flatnonzero(length == d)
                for a in range(0, len(rows), 2048):
                    at = rows[a : a + 2048]
                    x = np.array(batch.column(2).take(pa.array(at)).to_pylist())
                    row, number = code.decode(unit(x))
                    short = x.astype(np.float32)
                    lines = [(b"f" + a.tobytes()) if (a == b).all() else (b"d" + b.tobytes()) for a, b in zip(short, x)]
                    key = number * 8192 + min(int(d), 8191)
                    lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(np.bincount(row, minlength=len(at)))].astype(np.int32), pa.array(key[np.argsort(row, kind="stable")]))
                    take = pa.array(at)
                    lines = pa.array(lines, pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), lines, lists], ["node", "size", "raw", "filters"])

    placed = classes.select("node", "size", "vector").mapInArrow(spread, "node long, size long, raw binary, filters array<long>")
    placed = stored(placed, "filters")
    often = placed.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("members"))
    often = often.where(F.col("members") > MEMBERS).withColumn("parts", F.ceil(F.col("members") / MEMBERS).cast("int"))
    rows = placed.select(F.explode("filters").alias("filter"), "node", "size", "raw", "filters").join(often, "filter", "left")
    # a member of a large filter meets its own part and each other one
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("cell", F.least("part", "other").cast("long") * (1 << 31) + F.greatest("part", "other"))
    rows = rows.select("filter", "cell", "part", "node", "size", "raw", "filters").repartition("filter", "cell")
    rows = rows.sortWithinPartitions("filter", "cell")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, group in groups(batches):
            if group.num_rows < 2:
                continue
            cell = group.column("cell")[0].as_py()
            part = group.column("part").to_numpy() if cell >> 31 != cell & 0x7FFFFFFF else None
            node, size = group.column("node").to_numpy(), group.column("size").to_numpy()
            whole = [np.frombuffer(r, np.float32 if r[:1] == b"f" else np.float64, offset=1) for r in group.column("raw").to_pylist()]
            of_length = {n: np.array([i for i, v in enumerate(whole) if len(v) == n]) for n in {len(v) for v in whole}}
            filters = group.column("filters").to_pylist()
            for at in of_length.values():
                vectors = unit(np.array([whole[i] for i in at], np.float64))
                count, a, b = compare(number, node[at], size[at], vectors, [np.array(filters[i]) for i in at], cosine, None if part is None else part[at])
                some = np.flatnonzero(count)
                nothing = lambda n: pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(node[at][some]), pa.array(count[some]), nothing(len(some))], ["a", "n", "b"])
                yield pa.RecordBatch.from_arrays([pa.array(a), nothing(len(a)), pa.array(b)], ["a", "n", "b"])

    found = stored(rows.mapInArrow(link, "a long, n long, b long"), "links")
    linked = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    groups_ = components(found.where("b is not null").select("a", "b"))
    known = classes.join(linked, "node", "left").join(groups_, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    names = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(names, "component").select("vector", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    out = own.join(known, "vector", "left")
    component = F.when(vector.isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of each filter and cell from batches sorted by both."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        key, cell = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1, len(key)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if held and last != (key[a], cell[a]):
                yield int(last[0]), pa.Table.from_batches(held)
                held = []
            last = (key[a], cell[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield int(last[0]), pa.Table.from_batches(held)


@query("op5_embedding_near_duplicates")
def op5(spark, folder):
    return near_vectors(read(spark, folder, "embeddings"))
