"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: every node passes its smallest neighbour on to
its larger ones, then to its smaller ones, until each component is a star around its smallest
node.  A step is an aggregation with partial sums and a join that adaptive execution may
split at hot nodes; each round is cut by a written table.  Nothing goes to the driver but a
count and a checksum per round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` that is not the smallest of its component."""
    down = lambda df: df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, seen = cut_lineage(down(edges)), None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = cut_lineage(down(small))


class Forest:
    """Components of one task's nodes ``0..n-1`` while pairs arrive in blocks."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _flatten(self) -> None:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            self._flatten()

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Nodes that are no root, and their roots."""
        nodes = np.flatnonzero(self.root != np.arange(len(self.root)))
        return nodes, self.root[nodes]
