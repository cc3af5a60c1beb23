"""SimHash near-dedup by a self-join of the binary trie of fingerprints.

Distinct fingerprints are the leaves of a binary trie.  Pairs of nodes of one depth are
traversed together: each pair splits into the pairs of its children, the differing bits so
far are kept, and a pair goes as soon as they exceed the budget.  Spark traverses the top of
the trie: pairs of prefixes within the budget come from a join of the node table with its
flipped prefixes, and pairs with a crowded node are split further, four bits a step, however
deep it takes.  Each remaining pair is one group of bounded size, which a task finishes.

Copies share a fingerprint and are one leaf.  A task gives a spanning forest of the links it
finds, not the links, so no group emits all its pairs; components follow by
:mod:`kindred.llm.components`.

Defined cases: a NULL, empty or blank text has fingerprint zero and links like any other;
texts are read whole; rows of equal doc_id are separate rows of one id; a NULL doc_id is
never the smallest unless a component has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.components import Forest, connected_components
from kindred.llm.expressions import carry, only
from kindred.session import cut_lineage

BUDGET = 2
SHINGLE = 3
SEED = 42
#: Fingerprints a trie node may hold before its pairs are split further, and the least depth to begin at.
NODE_ROWS = 1 << 15
LEAST_DEPTH = 6
STEP = 4
#: Node pairs a task expands at once, pairs of leaves it compares at once, shingles it counts at once.
FRONTIER, LEAF_PAIRS, COUNT_ROWS = 1 << 18, 64, 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text: a bit is 1 where over half of its shingles' hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(stops), COUNT_ROWS):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + COUNT_ROWS], stops[k : k + COUNT_ROWS])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(stops), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, column: str = "fp") -> DataFrame:
    """Documents, without their text, with the fingerprint as a signed 64-bit integer."""
    kept = [c for c in docs.columns if c not in ("text", column)]

    def run(batches):
        for batch in batches:
            fps = np.array([simhash(x.as_py()) for x in batch.column(0)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps)], names=[*kept, column])

    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(column, T.LongType())])
    return docs.select("text", *kept).mapInArrow(run, schema)


def trie_pairs(a: np.ndarray, b: np.ndarray | None, budget: int = BUDGET, depth: int = 0):
    """Blocks ``(i, j)`` of places in sorted distinct ``a`` and ``b`` within ``budget`` bits.

    Without ``b`` the trie of ``a`` meets itself and each pair comes once.  Both sides are
    traversed from ``depth``, whose bits above are compared first.
    """
    alone, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    top = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    one = np.array([0])
    stack = [(depth, one, np.array([len(a)]), one, np.array([len(b)]), np.array([top]))] if top <= budget else []
    while stack:
        depth, al, ah, bl, bh, bits = stack.pop()
        small = (ah - al) * (bh - bl) <= LEAF_PAIRS
        if small.any():
            yield from _leaves(a, b, *(x[small] for x in (al, ah, bl, bh)), budget, alone)
            al, ah, bl, bh, bits = (x[~small] for x in (al, ah, bl, bh, bits))
        if not len(al):
            continue
        bit = np.uint64(63 - depth)
        ones_a = np.concatenate([[0], np.cumsum((a >> bit) & np.uint64(1), dtype=np.int64)])
        ones_b = ones_a if alone else np.concatenate([[0], np.cumsum((b >> bit) & np.uint64(1), dtype=np.int64)])
        am, bm = ah - (ones_a[ah] - ones_a[al]), bh - (ones_b[bh] - ones_b[bl])
        parts = [(al, am, bl, bm, bits), (am, ah, bm, bh, bits), (al, am, bm, bh, bits + 1)]
        parts.append((am, ah, bl, bm, np.where(alone & (al == bl), budget + 1, bits + 1)))  # a node with itself: once
        al, ah, bl, bh, bits = (np.concatenate(x) for x in zip(*parts))
        on = (ah > al) & (bh > bl) & (bits <= budget)
        rows = [x[on] for x in (al, ah, bl, bh, bits)]
        for k in range(0, len(rows[0]), FRONTIER):
            stack.append((depth + 1, *(x[k : k + FRONTIER] for x in rows)))


def _leaves(a, b, al, ah, bl, bh, budget, alone):
    width = bh - bl
    sizes = (ah - al) * width
    stops = np.cumsum(sizes)
    for first in range(0, len(al), FRONTIER // 8):
        part = slice(first, first + FRONTIER // 8)
        size, of = sizes[part], np.repeat(np.arange(len(sizes[part])), sizes[part])
        inside = np.arange(size.sum()) - np.repeat(stops[part] - size - (stops[part][0] - size[0]), size)
        i, j = al[part][of] + inside // width[part][of], bl[part][of] + inside % width[part][of]
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if alone:
            near &= i < j
        if near.any():
            yield i[near], j[near]


def _node_pairs(nodes: DataFrame, depth: int, budget: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes of one depth within the budget, each once."""
    masks = [sum(1 << i for i in bits) for n in range(min(budget, depth) + 1) for bits in combinations(range(depth), n)]
    flipped = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("m"))
    flipped = flipped.withColumn("b", F.col("a").bitwiseXOR(F.col("m"))).where("a <= b").drop("m")
    return flipped.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b").select("a", "b", "na", "nb")


def _prefix(depth: int):
    return F.shiftrightunsigned("fp", 64 - depth) if depth < 64 else F.col("fp")


def fingerprint_links(fps: DataFrame, rows: int, budget: int = BUDGET) -> DataFrame:
    """Spanning links ``(u, v)`` between ``rows`` distinct fingerprints within ``budget`` bits."""
    depth = min(24, max(LEAST_DEPTH, math.ceil(math.log2(max(1, rows) / NODE_ROWS))))
    count = lambda d: fps.groupBy(_prefix(d).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    frontier, members = cut_lineage(_node_pairs(count(depth), depth, budget)), []
    while True:
        crowded = (F.greatest("na", "nb") > 4 * NODE_ROWS) if depth < 64 else F.lit(False)
        ready = frontier.where(~crowded).withColumn("depth", F.lit(depth))
        sides = ready.select("depth", "a", "b", F.col("a").alias("node"), F.lit(0).alias("side")).unionByName(
            ready.where("a <> b").select("depth", "a", "b", F.col("b").alias("node"), F.lit(1).alias("side"))
        )
        members.append(fps.select("fp", _prefix(depth).alias("node")).join(sides, "node").select("depth", "a", "b", "side", "fp"))
        if depth == 64 or frontier.where(crowded).isEmpty():
            break
        deeper = min(64, depth + STEP)
        up = F.shiftrightunsigned("node", deeper - depth)
        child = lambda s, d=count(deeper), u=up: d.select(u.alias(s), F.col("node").alias(f"c{s}"), F.col("n").alias(f"c{s}n"))
        split = frontier.where(crowded).select("a", "b").join(child("a"), "a").join(child("b"), "b")
        split = split.where((F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= budget) & ((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb"))))
        frontier, depth = cut_lineage(split.select(F.col("ca").alias("a"), F.col("cb").alias("b"), F.col("can").alias("na"), F.col("cbn").alias("nb"))), deeper

    def link(table: pa.Table) -> pa.Table:
        fp, side = table["fp"].to_numpy().view(np.uint64), table["side"].to_numpy()
        left, right, depth = np.sort(fp[side == 0]), np.sort(fp[side == 1]), table["depth"][0].as_py()
        alone = table["a"][0] == table["b"][0]
        forest, shift = Forest(len(left) + len(right)), 0 if alone else len(left)
        for i, j in trie_pairs(left, None if alone else right, budget, depth):
            forest.join(i, j + shift)
        every = np.concatenate([left, right]).view(np.int64)
        nodes, roots = forest.edges()
        return pa.table({"u": pa.array(every[nodes], pa.int64()), "v": pa.array(every[roots], pa.int64())})

    placed = members[0]
    for more in members[1:]:
        placed = placed.unionByName(more)
    return placed.groupBy("depth", "a", "b").applyInArrow(link, "u long, v long")


def _components(prints: DataFrame, budget: int) -> DataFrame:
    """``(fp, root, component_id)`` of a written table of ``(doc_id, fp)``."""
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("_least")))
    links = fingerprint_links(classes.select("fp"), classes.count(), budget)
    roots = classes.join(connected_components(links), classes["fp"] == F.col("node"), "left")
    roots = roots.select("fp", F.coalesce("root", "fp").alias("root"), "_least")
    return cut_lineage(roots.join(roots.groupBy("root").agg(F.min("_least").alias("component_id")), "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every document."""
    prints = cut_lineage(with_fingerprints(only(docs, "doc_id", "text")))
    rows = prints.join(_components(prints, budget), "fp")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One document of every component, with its own columns: that of the smallest doc_id.

    Of several rows with that id, the one whose text has the smallest hash stays, once.
    """
    return carry(docs, ["doc_id", "text"], [], lambda rows: _first_of_each(rows, budget))


def _first_of_each(docs: DataFrame, budget: int) -> DataFrame:
    prints = cut_lineage(with_fingerprints(docs.select("doc_id", "text", F.xxhash64("text").alias("_t"))))
    rows = prints.join(_components(prints, budget), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = rows.groupBy("root", "doc_id").agg(F.min("_t").alias("_t")).select(F.col("doc_id").alias("_id"), "_t", F.lit(1).alias("_in"))
    keyed = docs.withColumn("_t", F.xxhash64("text"))
    found = keyed.join(stay.distinct(), F.col("doc_id").eqNullSafe(F.col("_id")) & (keyed["_t"] == stay["_t"]), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id", "_t").orderBy(F.lit(1)))
    return found.withColumn("_n", first).where("_n = 1")
