"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that an edge joins to another one.

    ``component`` is the smallest node that can be reached. Alternating large and
    small stars, so the number of rounds grows with the logarithm of the largest
    component. Edges stay in tables in the shared folder; the driver sees one
    count and one checksum per round. Null ends and loops are ignored.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Labels of connected items inside one task, grown by arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up
