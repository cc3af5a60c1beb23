"""Embedding near-dedup by spherical-cap filters from structured random product codes.

A filter direction is a pair of codewords, one per half of the rotated space, so ``k`` seeded
codewords a half make ``k * k`` directions.  Each vector is list-decoded to all directions it
exceeds ``alpha`` with (and the one it is nearest to): half scores are sorted and only code
pairs whose sum can reach the threshold are formed.  Vectors meet where they share a filter
and a label, and every pair that meets is verified by cosine in double precision.

``k`` follows the number of distinct vectors so that a bucket keeps about ``BUCKET`` of them,
and ``alpha`` follows ``k`` and the dimension so that a vector exceeds about ``FILTERS``
directions.  Recall on links at cosine 0.98 is measured in the tests (0.9 is asked).

Equal vectors of a label are one class with a count.  A bucket with more than ``HOT_ROWS``
classes is dealt as pairs of chunks, none larger, so no bucket is capped.  A pair that meets
in several buckets counts in the one of smallest number; a bucket gives counts and a spanning
forest, never its pairs.

Defined cases: a vector that is NULL, empty, zero or holds NULL or non-finite components, and
any vector without a label, has no links and is its own component; vectors of different
length never link; rows of equal vec_id are separate vectors; a NULL vec_id is never the
smallest unless a component has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import Forest, connected_components
from kindred.llm.expressions import only
from kindred.session import cut_lineage, task_count

COSINE = 0.98
TABLES = 2
FILTERS = 9
BUCKET = 16
LEAST_CODES = 16
LEAST_DIM = 16
HOT_ROWS = 4096
#: Rows of one block product, pairs expanded at once, rows from which a bucket is multiplied as a block.
BLOCK, PAIRS, WIDE = 1024, 200_000, 96
SEED = 7


def code_count(n: int) -> int:
    """Codewords per half for ``n`` vectors, rounded up to a power of two (square root)."""
    return max(LEAST_CODES, 1 << math.ceil(math.log2(max(1.0, n * FILTERS / BUCKET)) / 2))


def threshold(dim: int, k: int) -> float:
    """Cosine that a random direction exceeds with probability ``FILTERS / k^2``."""
    t = np.linspace(-1, 1, 400_001)[1:-1]
    density = np.exp((dim - 3) / 2 * np.log1p(-t * t))
    tail = np.cumsum(density[::-1])[::-1] / density.sum()
    return float(t[np.searchsorted(-tail, -min(0.5, FILTERS / k**2))])


@cache
def _codes(dim: int, k: int, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotation and the codewords of both halves for vectors of ``dim`` components."""
    rng = np.random.default_rng([SEED, dim, k, table])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = [rng.standard_normal((k, dim // 2)), rng.standard_normal((k, dim - dim // 2))]
    return rotation, *[h / np.linalg.norm(h, axis=1, keepdims=True) for h in halves]


def decode(vectors: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted numbers of all filters that each unit vector exceeds, and its nearest one per table."""
    n, dim = vectors.shape
    if dim < LEAST_DIM:
        vectors, dim = np.pad(vectors, ((0, 0), (0, LEAST_DIM - dim))), LEAST_DIM
    need, found = threshold(dim, k) * math.sqrt(2), [[] for _ in range(n)]
    for table in range(TABLES):
        rotation, left, right = _codes(dim, k, table)
        turned = vectors @ rotation
        a, b = turned[:, : dim // 2] @ left.T, turned[:, dim // 2 :] @ right.T
        order = np.argsort(-b, axis=1)
        b = np.take_along_axis(b, order, axis=1)
        for row in range(n):
            down, best = -b[row], int(np.argmax(a[row]))
            codes = np.flatnonzero(a[row] + b[row, 0] >= need)
            counts = np.searchsorted(down, a[row, codes] - need, side="right")
            first = np.repeat(codes, counts)
            second = np.concatenate([order[row, :c] for c in counts]) if len(codes) else first
            numbers = np.append(first * k + second, best * k + order[row, 0])
            found[row].append(np.unique(numbers) + table * k * k)
    return [np.concatenate(x) for x in found]


def _unit(column) -> np.ndarray:
    rows = column.to_numpy(zero_copy_only=False)
    v = np.zeros((len(rows), max(map(len, rows), default=0)))  # zeros behind shorter vectors change no product
    for i, x in enumerate(rows):
        v[i, : len(x)] = x
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class _Buckets:
    """Links inside complete buckets of one task; rows stand bucket by bucket."""

    def __init__(self, table: pa.Table, cosine: float):
        self.cosine, self.cid = cosine, table["cid"].to_numpy()
        self.size = table["n"].to_numpy()
        self.vectors = _unit(table["embedding"].combine_chunks())
        self.side, self.filter = table["side"].to_numpy(), table["filter"].to_numpy()
        lists = table["filters"].to_pylist()
        self.filters = np.full((len(lists), max(map(len, lists))), -1, dtype=np.int64)
        for i, x in enumerate(lists):
            self.filters[i, : len(x)] = x
        self.links, self.forest = np.zeros(len(lists), dtype=np.int64), Forest(len(lists))
        self.chunked = table["chunks"].to_numpy()

    def _count(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.links, i, self.size[j])
        np.add.at(self.links, j, self.size[i])
        self.forest.join(i, j)

    def few(self, starts: np.ndarray, stops: np.ndarray) -> None:
        """All pairs of many small one-sided buckets."""
        n = stops - starts
        sizes = n * n
        ends = np.cumsum(sizes)
        first = 0
        while first < len(n):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, side="right")))
            size, of = sizes[first:last], np.repeat(np.arange(first, last), sizes[first:last])
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            i, j = starts[of] + inside // n[of], starts[of] + inside % n[of]
            i, j = i[i < j], j[i < j]
            near = np.einsum("ij,ij->i", self.vectors[i], self.vectors[j]) >= self.cosine
            i, j = i[near], j[near]
            for k in range(0, len(i), PAIRS // 8):
                self._first_meeting(i[k : k + PAIRS // 8], j[k : k + PAIRS // 8])
            first = last

    def _first_meeting(self, i: np.ndarray, j: np.ndarray) -> None:
        mine = np.where(self.filters[i] < self.filter[i][:, None], self.filters[i], -1)
        before = ((mine[:, :, None] == self.filters[j][:, None, :]) & (mine >= 0)[:, :, None]).any(axis=(1, 2))
        self._count(i[~before], j[~before])

    def many(self, start: int, stop: int) -> None:
        """Pairs of one large bucket, or between the two sides of a pair of chunks, block by block."""
        rows = np.arange(start, stop)
        left, right = (rows[self.side[rows] == 0], rows[self.side[rows] == 1])
        alone = not len(right)
        right = left if alone else right
        known = self.filters[rows]
        before = np.unique(known[(known >= 0) & (known < self.filter[start])])
        place = {row: k for k, row in enumerate(rows.tolist())}
        held = np.zeros((len(rows), len(before)), dtype=np.float32)
        for c in range(known.shape[1]):
            at = np.searchsorted(before, known[:, c])
            hit = (at < len(before)) & (before[np.minimum(at, len(before) - 1)] == known[:, c]) if len(before) else np.zeros(len(rows), bool)
            held[np.flatnonzero(hit), at[hit]] = 1
        for p in range(0, len(left), BLOCK):
            for q in range(p if alone else 0, len(right), BLOCK):
                x, y = left[p : p + BLOCK], right[q : q + BLOCK]
                near = self.vectors[x] @ self.vectors[y].T >= self.cosine
                hx, hy = held[[place[r] for r in x.tolist()]], held[[place[r] for r in y.tolist()]]
                near &= (hx @ hy.T) == 0
                if alone and p == q:
                    near = np.triu(near, 1)
                i, j = np.nonzero(near)
                self.links[x] += near @ self.size[y]
                self.links[y] += near.T @ self.size[x]
                self.forest.join(x[i], y[j])

    def result(self) -> pa.RecordBatch:
        """Links per class, and with each the class it hangs on in the forest."""
        hit = np.flatnonzero(self.links)
        return pa.RecordBatch.from_pydict({
            "cid": pa.array(self.cid[hit]), "links": pa.array(self.links[hit]), "root": pa.array(self.cid[self.forest.root[hit]]),
        })


def _bucket_links(placed: DataFrame, cosine: float) -> DataFrame:
    """``(cid, links, root)`` by bucket from rows sorted by bucket in every partition."""

    def settle(table: pa.Table):
        b = _Buckets(table, cosine)
        key = table["bucket"].combine_chunks().to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        stops = np.append(starts[1:], len(key))
        wide = (stops - starts > WIDE) | (b.chunked[starts] > 1)
        small = ~wide & (stops - starts > 1)
        b.few(starts[small], stops[small])
        for s, e in zip(starts[wide], stops[wide]):
            b.many(s, e)
        return b.result()

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            if table.num_rows < HOT_ROWS:
                continue
            keys = table["bucket"].combine_chunks().to_numpy(zero_copy_only=False)
            whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            if whole:
                yield settle(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held and sum(x.num_rows for x in held):
            yield settle(pa.Table.from_batches(held))

    return placed.mapInArrow(run, "cid long, links long, root long")


def _usable(vector: str = "embedding"):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0) & F.col("label").isNotNull()


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of (vec_id, embedding, label)."""
    rows = only(vectors, "vec_id", "embedding", "label").withColumn("_use", F.coalesce(_usable(), F.lit(False)))
    good, rest = rows.where("_use").drop("_use"), rows.where("NOT _use")
    classes = good.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = cut_lineage(classes.withColumn("cid", F.monotonically_increasing_id()))
    codes, spark = code_count(classes.count()), vectors.sparkSession

    def lists(batches):
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(1)])
            out = [np.array([], dtype=np.int64)] * len(sizes)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for k in range(0, len(at), 512):
                    part = at[k : k + 512]
                    for i, x in zip(part, decode(_unit(batch.column(1).take(pa.array(part))), codes)):
                        out[i] = x
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["cid", "filters"])

    decoded = classes.select("cid", "embedding").repartition(task_count(spark), "cid").mapInArrow(lists, "cid long, filters array<long>")
    known = cut_lineage(classes.select("cid", "label", "embedding", "n").join(decoded, "cid"))
    copies = known.select("cid", "label", F.size("embedding").alias("dim"), F.explode("filters").alias("filter"))
    counts = copies.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    chunks = F.ceil(F.col("rows") / HOT_ROWS).cast("int")
    meet = copies.join(counts, ["label", "dim", "filter"]).withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("cid"), "chunks").cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    meet = meet.withColumn("other", others).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    bucket = F.concat_ws(":", "label", "dim", F.format_string("%012d", "filter"), "low", "high")
    meet = meet.select("cid", "filter", "chunks", bucket.alias("bucket"), F.when((F.col("own") == F.col("high")) & (F.col("low") != F.col("high")), 1).otherwise(0).alias("side"))
    placed = meet.join(known.select("cid", "n", "embedding", "filters"), "cid")
    placed = placed.repartition(task_count(spark), "bucket").sortWithinPartitions("bucket")
    found = cut_lineage(_bucket_links(placed, cosine))
    roots = connected_components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    placed = classes.join(sums, "cid", "left").join(roots, classes["cid"] == roots["node"], "left")
    placed = placed.select("label", "embedding", "n", "least", "links", F.coalesce("root", "cid").alias("root"))
    placed = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    linked = good.join(placed, ["label", "embedding"]).select(
        "vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
