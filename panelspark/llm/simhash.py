"""SimHash near-duplicates: fingerprints, and BK-trees that find close ones."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import Forest, components
from .tables import numbered, query, read

BITS = 64


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles of a text; see :func:`fingerprints`."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), last.tolist())])
    ones = np.zeros(BITS, np.int64)
    bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for i in range(0, len(bits), 8192):
        ones += np.unpackbits(bits[i : i + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) with the 64-bit fingerprint as a signed long.

    A-Z is lower-cased; words are joined by one space into shingles, repeats
    included; a shorter text is one shingle, a text without words (null too) has
    fingerprint zero. A bit is set if over half of the XXH64 hashes (seed 42) have it.
    """
    schema = docs.select(id_col).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], [id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


class Trees:
    """A forest of BK-trees, one for each shard, in flat arrays.

    A node's children are keyed by their Hamming distance to it. All trees grow
    level by level: the first item of a group becomes its node, the others
    descend along the edge of their distance.
    """

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        n = len(values)
        self.values = values
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        self.shard = shard
        items = np.lexsort((np.arange(n), shard))
        group = shard[items]
        up = np.full(n, -1)
        first_level = True
        while len(items):
            head = np.ones(len(items), bool)
            head[1:] = group[1:] != group[:-1]
            node = items[np.maximum.accumulate(np.where(head, np.arange(len(items)), 0))]
            heads = items[head]
            if first_level:
                self.roots = heads
                first_level = False
            else:
                parent[heads], edge[heads] = up[heads], group[head] % (BITS + 1)
            items, node = items[~head], node[~head]
            distance = np.bitwise_count(values[items] ^ values[node]).astype(np.int64)
            up[items] = node
            group = node * (BITS + 1) + distance
            order = np.argsort(group, kind="stable")
            items, group = items[order], group[order]
        child = np.flatnonzero(parent >= 0)
        key = parent[child] * (BITS + 1) + edge[child]
        order = np.argsort(key, kind="stable")
        self.keys, self.children = key[order], child[order]

    def near(self, radius: int, chunk: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of items of one shard within the radius, each pair once."""
        n = len(self.values)
        root = self.roots[np.searchsorted(self.shard[self.roots], self.shard)]
        for begin in range(0, n, chunk):
            asked = np.arange(begin, min(n, begin + chunk))
            node = root[asked]
            while len(asked):
                distance = np.bitwise_count(self.values[asked] ^ self.values[node]).astype(np.int64)
                hit = (distance <= radius) & (asked < node)
                if hit.any():
                    yield asked[hit], node[hit]
                low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(distance - radius, 0))
                high = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(distance + radius, BITS), "right")
                many = high - low
                asked = np.repeat(asked, many)
                at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
                node = self.children[at]


def blocks_for(n: int, radius: int) -> int:
    """How many blocks a fingerprint is cut into, so that random shards stay small.

    With ``m`` blocks, ``m - radius`` of them are equal in any linked pair; together
    they have about ``64 * (m - radius) / m`` bits, which should tell ``n / 32`` apart.
    """
    for m in range(radius + 1, 2 * radius + 1):
        if n <= 32 * 2 ** (BITS * (m - radius) / m):
            return m
    return 2 * radius


def shard_keys(fp: Column, radius: int, blocks: int) -> list[Column]:
    """One key for each choice of the blocks that may be equal (pigeonhole)."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for n, choice in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in choice)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(mask))))
    return keys


def links(classes: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect every pair within ``radius`` bits.

    Each fingerprint goes to one shard for each choice of blocks that must be equal
    if two differ in few bits. A task builds the BK-trees of its shards, asks each
    for all its members, and returns one edge from each member to the first one of
    its group: at most one row for each row read, however many pairs are close.
    """
    blocks = blocks_for(classes.count(), radius)
    spread = classes.select("fp", F.explode(F.array(*shard_keys(F.col("fp"), radius, blocks))).alias("shard"))
    spread = spread.repartition("shard").select("shard", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        shard, fp = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((fp, shard))
        shard, fp = shard[order], fp[order]
        # shards of one row have no pair
        alone = np.ones(len(shard), bool)
        alone[1:] &= shard[1:] != shard[:-1]
        alone[:-1] &= shard[1:] != shard[:-1]
        shard, fp = shard[~alone], fp[~alone]
        if not len(fp):
            return
        forest = Forest(len(fp))
        for a, b in Trees(fp.view(np.uint64), shard).near(radius):
            forest.join(a, b)
        member = np.flatnonzero(forest.label != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[forest.label[member]]), pa.array(fp[member])], ["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row for each document: id, fingerprint (16 hex digits), component_id.

    Two documents are linked if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id that links reach. Documents with equal
    fingerprints are one node, so copies cost nothing. Null texts have fingerprint
    zero; a null id keeps its row and never names a component with another id;
    repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    own = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    classes = stored(own.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    found = components(links(classes, radius))
    grouped = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fp"))
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "component").select("fp", "component_id")
    return own.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without near-duplicates: of each group the smallest id stays.

    A null id stays only where the group has no other; of rows with equal ids one stays.
    """
    rows, number = numbered(docs)
    groups = near_duplicates(rows, id_col=number, text_col=text_col).select(F.col(number).alias("n"), "component_id")
    ids = rows.select(F.col(number).alias("n"), F.struct(F.isnull(id_col), F.col(id_col), F.col(number)).alias("order"))
    first = groups.join(ids, "n").groupBy("component_id").agg(F.min_by("n", "order").alias(number)).select(number)
    return rows.join(first, number, "left_semi").select(*docs.columns)


@query("op10_simhash_near_duplicates")
def op10(spark, folder):
    return near_duplicates(read(spark, folder, "documents"))
