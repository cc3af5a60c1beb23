"""Exact similarity join by an inverted index of positional bigrams.

Two texts of lengths a and b whose indel similarity reaches t differ by at most
``D = (a + b)(1 - t / 100)`` insertions and deletions.  With x letters of the
first and y of the second outside the common subsequence, at least
``a - 1 - 2x - y`` bigrams of the first stand in the second too, moved by -x to y
places (the same number from the other side).  So of each text only a prefix
is indexed: its bigrams in a global order, rarest first, less as many as may be
missing from it.  Any two similar texts share a bigram of both prefixes, near
the same place; Spark joins the prefixes, and lengths, places and distinct
pairs are settled before a pair is scored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import fuzzy
from kindred.session import cut_lineage, shuffled, spread

SLACK = 1e-9
#: Lowest threshold at which every pair of lengths must share a bigram.
LEAST_THRESHOLD = 80.0
#: Texts per side on which the matches of a pair are measured.
SAMPLE_TEXTS = 1000


def _lost(a: Column, b: Column, t: float) -> tuple[Column, Column]:
    """Most letters of either text outside the common subsequence."""
    edits = F.floor((a + b) * (1.0 - t / 100.0) + SLACK).cast("int")
    edits = edits - F.pmod(edits - (a - b), F.lit(2))  # lengths fix the parity
    return F.floor((edits + a - b) / 2).cast("int"), F.floor((edits - a + b) / 2).cast("int")


def _partners(n: Column, t: float) -> Column:
    """Lengths of possible partners."""
    grow = (200.0 - t) / t
    return F.sequence(F.ceil(n / grow - SLACK).cast("int"), F.floor(n * grow + SLACK).cast("int"))


def prefix_size(n: Column, t: float) -> Column:
    """Bigrams of a text of length ``n`` that must be indexed."""

    def missing(b: Column) -> Column:
        x, y = _lost(n, b, t)
        return F.when((x >= 0) & (y >= 0), 2 * x + y).otherwise(0)

    return F.array_max(F.transform(_partners(n, t), missing)) + 1


def bigrams(texts: DataFrame, key: str) -> DataFrame:
    """``(key, n, pos, gram)`` of every bigram of ``texts(key, text)``."""
    cut = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: F.substring(F.col("text"), i, F.lit(2)))
    sized = spread(texts.select(key, "text", F.length("text").alias("n")), key).where("n > 1")
    return sized.select(key, "n", F.posexplode(cut).alias("pos", "gram"))


def prefixes(grams: DataFrame, frequency: DataFrame, key: str, t: float) -> DataFrame:
    """The rarest bigrams of each text, as many as its length asks for."""
    place = F.row_number().over(Window.partitionBy(key).orderBy("df", "gram", "pos"))
    return grams.join(frequency, "gram").withColumn("nth", place).where(F.col("nth") <= prefix_size(F.col("n"), t)).select(key, "n", "pos", "gram")


class GramIndex:
    """Prefixes of both sides, written, with the number of matches that their join makes."""

    def __init__(self, queries: DataFrame, names: DataFrame, t: float):
        if t < LEAST_THRESHOLD:
            raise ValueError("texts this different may share no bigram")
        self.t, self.queries, self.names = t, queries, names
        left, right = bigrams(queries, "query_id"), bigrams(names, "row_id")
        frequency = left.select("gram").unionByName(right.select("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
        frequency = cut_lineage(frequency)
        self.left, self.right = (cut_lineage(prefixes(g, frequency, k, t)) for g, k in ((left, "query_id"), (right, "row_id")))

    def matches(self) -> int:
        """Rows of the join of equal bigrams, before places and lengths are looked at."""
        per_gram = [df.groupBy("gram").agg(F.count(F.lit(1)).alias(n)) for df, n in ((self.left, "l"), (self.right, "r"))]
        return int(per_gram[0].join(per_gram[1], "gram").agg(F.sum(F.col("l") * F.col("r"))).first()[0] or 0)

    def candidates(self) -> DataFrame:
        """``(query_id, row_id)``: pairs that share a bigram of both prefixes near the same place, once each."""
        left = self.left.select("query_id", "gram", F.col("n").alias("a"), F.col("pos").alias("i"))
        right = self.right.select("row_id", "gram", F.col("n").alias("b"), F.col("pos").alias("j"))
        x, y = _lost(F.col("a"), F.col("b"), self.t)
        moved = F.col("j") - F.col("i")
        near = left.join(shuffled(right), "gram").where((x >= 0) & (y >= 0) & (moved >= -x) & (moved <= y))
        return near.select("query_id", "row_id").distinct()

    def best(self) -> DataFrame:
        """``(query_id, row_id, score)``: best name of every query that reaches the threshold, the lower row_id on ties."""
        pairs = self.candidates().join(shuffled(self.queries.select("query_id", "text")), "query_id")
        pairs = pairs.join(shuffled(self.names.select("row_id", F.col("text").alias("name"))), "row_id")
        scored = pairs.withColumn("score", fuzzy.indel_ratio("text", "name")).where(F.col("score") >= self.t - SLACK)
        best = F.max_by(F.struct("row_id", "score"), F.struct(F.col("score"), -F.col("row_id")))
        return scored.groupBy("query_id").agg(best.alias("b")).select("query_id", "b.row_id", "b.score")


def matches_per_pair(queries: DataFrame, names: DataFrame, t: float) -> float:
    """Matches of a pair of texts on average, from the ``SAMPLE_TEXTS`` texts of smallest hash of each side."""
    left, right = ([r["text"] for r in df.orderBy(F.xxhash64("text"), "text").select("text").limit(SAMPLE_TEXTS).collect()] for df in (queries, names))
    cut = [[[x[i : i + 2] for i in range(len(x) - 1)] for x in side] for side in (left, right)]
    df = Counter(g for side in cut for grams in side for g in grams)
    held = [Counter(g for grams in side for g in sorted(grams, key=lambda g: (df[g], g))[: _indexed(len(grams) + 1, t)]) for side in cut]
    return sum(n * held[1][g] for g, n in held[0].items()) / max(len(left) * len(right), 1)


@cache
def _indexed(n: int, t: float) -> int:
    """:func:`prefix_size` of one length."""
    grow, most = (200.0 - t) / t, 0
    for b in range(math.ceil(n / grow - SLACK), math.floor(n * grow + SLACK) + 1):
        edits = math.floor((n + b) * (1.0 - t / 100.0) + SLACK)
        edits -= (edits - (n - b)) % 2
        x, y = (edits + n - b) // 2, (edits - n + b) // 2
        if x >= 0 and y >= 0:
            most = max(most, 2 * x + y)
    return most + 1
