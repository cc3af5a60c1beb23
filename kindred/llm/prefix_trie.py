"""Prefix trie of conversations that borrow the head of another: composable fingerprints.

Turns become elements of a monoid, ``(length, hash)`` with ``(n, g) (m, h) = (n + m, g B^m + h)``.
One ordered scan gives every conversation's prefix products; the product of a rebuilt
conversation, a base's head followed by its own suffix, is then arithmetic on two of them, so
no rebuilt text ever exists.  Equal depth and product make a node.

Products hash turns that are themselves hashed.  Both steps are verified: turns of equal hash
are compared byte for byte, and the members of a node must refer to equal last turns; with
the parent verified likewise, equal products are equal sequences.  If a check fails, all is
done again with other constants.

Sums over subtrees need no walk: a node belongs to the chain of its smallest member, whose
nodes are a run of depths; a subtree's sum is the chain's sum from the node downwards plus the
whole chains of all other members.

Scans are ranged by (conversation, order), so that one conversation may fill many tasks; what
a task needs from those before it is one row per task.  Attributes of a conversation meet its
rows in blocks of ``BLOCK``, never all rows of one under a single key.  Lists of members are
hashed as a stream of packed runs in order.

Defined cases: rows without conv_id belong to no conversation and are left out; a NULL turn
comes first, a NULL role or text counts as empty; equal turn numbers are ordered by role, then
by hash of the text, so reruns agree; repeated rows are turns of their own; an empty table has
no root; other columns are ignored.  Families of a negative conv_id are floored (-5 borrows
from -100).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.expressions import only
from kindred.session import cut_lineage, task_count

FAMILY, HEADS = 100, 6
PRIME = (1 << 61) - 1
#: Constants of each attempt: bases of both lanes, seed of the second hash.
ATTEMPTS = ((1_465_372_903_911_827_341, 913_784_226_019_385_977, 1), (733_910_462_185_736_031, 2_019_384_756_102_938_475, 2))
BLOCK = 256
#: Characters of member ids that one packed row holds at most.
PACKED = 1 << 16
NODE = ["depth", "k1", "k2"]
RESULTS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Collision(Exception):
    """Different turns or sequences had equal fingerprints."""


def turn_elements(conversations: DataFrame, seed: int) -> DataFrame:
    """``(c, turn, role, x, y, length, text)``: turns with two hashes below ``PRIME``."""
    rows = only(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return rows.select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.pmod(F.xxhash64(role, text), F.lit(PRIME)).alias("x"), F.pmod(F.xxhash64(F.lit(seed), text, role), F.lit(PRIME)).alias("y"),
        F.char_length(text).cast("long").alias("length"), text.alias("text"),
    )


def _differ(*names: str) -> Column:
    return F.expr(" OR ".join(f"min({n}) <> max({n})" for n in names))


def check_turns(turns: DataFrame) -> None:
    """Compare the bytes of all turns that share a hash."""
    unequal = turns.groupBy("x", "y").agg(_differ("role", "text").alias("bad")).where("bad")
    if unequal.limit(1).count():
        raise Collision("turns")


def running(df: DataFrame, key: str, order: list[Column], bases: tuple[int, int]) -> DataFrame:
    """``df`` with inclusive results along each key: ``i`` (count), ``p1`` and ``p2`` (products of
    ``x`` and ``y``), ``s1`` and ``s2`` (sums of ``v`` and ``w``).

    ``df`` needs those four long columns.  Each task scans its range; the few rows of a key
    that began in an earlier range are then completed with one carried result per task.
    """
    columns = df.columns
    schema = pa.schema([*[(n, _arrow(t)) for n, t in df.dtypes], *[(n, pa.int64()) for n in ("i", "p1", "p2", "s1", "s2")], ("part", pa.int32())])
    b1, b2 = bases

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, now = TaskContext.get().partitionId(), None
        i = p1 = p2 = s1 = s2 = 0
        for batch in batches:
            out = []
            for k, x, y, v, w in zip(*[batch.column(columns.index(n)).to_pylist() for n in (key, "x", "y", "v", "w")]):
                if k != now:
                    now, i, p1, p2, s1, s2 = k, 0, 0, 0, 0, 0
                i, p1, p2, s1, s2 = i + 1, (p1 * b1 + x) % PRIME, (p2 * b2 + y) % PRIME, s1 + v, s2 + w
                out.append((i, p1, p2, s1, s2, part))
            made = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 5 + [pa.int32()])] if out else []
            if made:
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema=schema)

    ranged = df.repartitionByRange(task_count(df.sparkSession), F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    local = cut_lineage(ranged.mapInArrow(scan, _ddl(df) + ", i long, p1 long, p2 long, s1 long, s2 long, part int"))
    ends = local.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct(key, "i", "p1", "p2", "s1", "s2")).alias("last"))
    carried, before = {}, None
    for row in sorted(ends.collect()):  # one row per task
        first, last = row["first"], tuple(row["last"])
        if before and before[0] == first:
            carried[row["part"]] = before
        if before and before[0] == last[0]:
            last = (last[0], *_joined(before[1:], last[1:], bases))
        before = last
    if not carried:
        return local.drop("part")

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, table = batch.column("part"), batch.to_pydict()
            if batch.num_rows and any(p in carried for p in set(part.to_pylist())):
                for at, (p, k) in enumerate(zip(table["part"], table[key])):
                    if p in carried and carried[p][0] == k:
                        state = _joined(carried[p][1:], tuple(table[n][at] for n in ("i", "p1", "p2", "s1", "s2")), bases)
                        for n, value in zip(("i", "p1", "p2", "s1", "s2"), state):
                            table[n][at] = value
                yield pa.RecordBatch.from_pydict(table, schema=batch.schema)
            else:
                yield batch

    return local.mapInArrow(complete, local.schema).drop("part")


def _joined(a: tuple, b: tuple, bases: tuple[int, int]) -> tuple:
    """Result of a run followed by another."""
    n = b[0]
    return (a[0] + n, *[(p * pow(base, n, PRIME) + q) % PRIME for p, q, base in zip(a[1:3], b[1:3], bases)], a[3] + b[3], a[4] + b[4])


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string()}[kind]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)


def head_length(c: Column, heads: int) -> Column:
    return (F.crc32(c.cast("string").cast("binary")) % heads).cast("long")


def rebuilt_prefixes(turns: DataFrame, family: int, heads: int, bases: tuple[int, int]) -> DataFrame:
    """``(c, depth, k1, k2, q1, q2, x, y, length, ends)``: every prefix of every rebuilt conversation.

    ``k`` is its product and ``q`` its parent's, ``x`` and ``y`` refer to its last turn.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("x"), F.col("y")]
    zero = F.lit(0).cast("long")
    ranged = turns.select("c", "turn", "role", "x", "y", "length", zero.alias("v"), zero.alias("w"))
    own = cut_lineage(running(ranged, "c", order, bases).select("c", "i", "p1", "p2", "x", "y", "length"))
    first = F.when(F.col("i") < heads, F.struct("i", "p1", "p2", "x", "y", "length"))
    convs = own.groupBy("c").agg(F.max("i").alias("n"), F.array_sort(F.collect_list(first)).alias("head")).withColumn("h", head_length(F.col("c"), heads))
    base = convs.where(F.pmod("c", F.lit(family)) == 0).select(F.col("c").alias("base"), F.col("head").alias("base_head"))
    convs = convs.withColumn("base", F.col("c") - F.pmod("c", F.lit(family))).join(base, "base", "left")
    convs = convs.withColumn("borrowed", F.slice(F.coalesce("base_head", F.array().cast(base.schema["base_head"].dataType)), F.lit(1), F.col("h").cast("int")))
    last = F.try_element_at("borrowed", F.lit(-1))
    convs = convs.select(
        "c", "n", "h", "borrowed", F.size("borrowed").cast("long").alias("hb"), *[F.coalesce(last[p], zero).alias(f"b{p[1]}") for p in ("p1", "p2")],
        *[F.when(F.col("h") > 0, F.coalesce(F.get("head", F.col("h").cast("int") - 1)[p], zero)).otherwise(zero).alias(f"o{p[1]}") for p in ("p1", "p2")],
    )
    convs = cut_lineage(convs.withColumn("total", F.col("hb") + F.greatest(F.col("n") - F.col("h"), zero)))
    suffix = own.where(F.col("i") > head_length(F.col("c"), heads)).withColumn("block", F.floor(F.col("i") / BLOCK))
    info = convs.where("n > h").select(
        "c", "h", "hb", "b1", "b2", "o1", "o2", "total", F.explode(F.sequence(F.floor((F.col("h") + 1) / BLOCK), F.floor(F.col("n") / BLOCK))).alias("block"))
    schema = "c long, depth long, k1 long, k2 long, q1 long, q2 long, x long, y long, length long, ends long"
    backs = [pow(b, -1, PRIME) for b in bases]

    def parents(k: list[int], x: list[int], lane: int) -> list[int]:
        back = backs[lane]
        return [(a - b) * back % PRIME for a, b in zip(k, x)]

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers: dict[int, tuple[int, int]] = {}
        for batch in batches:
            t = batch.to_pydict()
            out = {"c": t["c"], "depth": [hb + i - h for hb, i, h in zip(t["hb"], t["i"], t["h"])]}
            for i, h in zip(t["i"], t["h"]):
                if i - h not in powers:
                    if len(powers) > 100_000:
                        powers.clear()
                    powers[i - h] = tuple(pow(b, i - h, PRIME) for b in bases)
            for lane in (0, 1):
                names = (f"p{lane + 1}", f"b{lane + 1}", f"o{lane + 1}", "i", "h")
                out[f"k{lane + 1}"] = [(p + (b - o) * (powers.get(i - h) or tuple(pow(z, i - h, PRIME) for z in bases))[lane]) % PRIME
                                       for p, b, o, i, h in zip(*[t[n] for n in names])]
            for lane, e in ((0, "x"), (1, "y")):
                out[f"q{lane + 1}"] = parents(out[f"k{lane + 1}"], t[e], lane)
            out |= {n: t[n] for n in ("x", "y", "length")} | {"ends": [int(d == n) for d, n in zip(out["depth"], t["total"])]}
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.to_pydict()
            t |= {"q1": parents(t["k1"], t["x"], 0), "q2": parents(t["k2"], t["y"], 1)}
            yield pa.RecordBatch.from_pydict({n: pa.array(t[n], pa.int64()) for n in ("c", "depth", "k1", "k2", "q1", "q2", "x", "y", "length", "ends")})

    suffixes = suffix.join(info, ["c", "block"]).mapInArrow(compose, schema)
    heads_of = convs.select("c", "total", F.explode("borrowed").alias("t")).select(
        "c", F.col("t.i").alias("depth"), F.col("t.p1").alias("k1"), F.col("t.p2").alias("k2"), "t.x", "t.y", "t.length",
        (F.col("t.i") == F.col("total")).cast("long").alias("ends"))
    nothing = [zero.alias(n) for n in ("depth", "k1", "k2", "q1", "q2", "x", "y", "length")]
    roots = convs.select("c", *nothing, (F.col("total") == 0).cast("long").alias("ends"))
    return cut_lineage(suffixes.unionByName(heads_of.mapInArrow(link, schema)).unionByName(roots))


def trie_nodes(prefixes: DataFrame) -> DataFrame:
    """Nodes with their smallest member ``owner``, members, children, length of the last turn and parent's product."""
    nodes = cut_lineage(prefixes.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("owner"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.max("length").alias("length"),
        _differ("x", "y", "q1", "q2").alias("bad")))
    if nodes.where("bad").limit(1).count():
        raise Collision("prefixes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2"))
    joined = nodes.drop("bad").join(children.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left")
    return cut_lineage(joined.fillna(0, ["n_children"]))


def subtree_sums(nodes: DataFrame, prefixes: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """Per node ``n_leaves`` and ``saved_tokens`` of its subtree."""
    zero = F.lit(0).cast("long")
    valued = nodes.select(*NODE, "owner", zero.alias("x"), zero.alias("y"), ((F.col("n_convs") - 1) * F.col("length")).alias("v"),
                          (F.col("n_children") == 0).cast("long").alias("w"))
    below = cut_lineage(running(valued, "owner", [F.desc("depth")], bases).select(*NODE, "owner", "v", "w", "s1", "s2"))
    chains = below.groupBy("owner").agg(F.min("depth").alias("top"), F.sum("v").alias("v"), F.sum("w").alias("w")).where("top > 0")
    chains = chains.select(F.col("owner").alias("c"), "top", "v", "w", F.explode(F.sequence(zero, F.floor((F.col("top") - 1) / BLOCK))).alias("block"))
    above = prefixes.select("c", *NODE, F.floor(F.col("depth") / BLOCK).alias("block")).join(chains, ["c", "block"]).where("depth < top")
    others = above.groupBy(*NODE).agg(F.sum("v").alias("others_v"), F.sum("w").alias("others_w"))
    total = lambda s, o: F.col(s) + F.coalesce(o, zero)
    return below.join(others, NODE, "left").select(*NODE, total("s2", "others_w").alias("n_leaves"), total("s1", "others_v").alias("saved_tokens"))


def member_digests(prefixes: DataFrame) -> DataFrame:
    """Per node where conversations end: SHA-256 of their ids, ascending, joined by commas."""
    parts = task_count(prefixes.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list]]:
        for batch in batches:
            yield from zip(zip(*[batch.column(n).to_pylist() for n in NODE]), *[batch.column(n).to_pylist() for n in names])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0  # packed runs; the last one is open
        now, start, ids, size = None, 0, [], 0
        for node, c in runs(batches, ["c"]):
            if node != now or size > PACKED:
                if ids:
                    rows.append((*now, start, ",".join(ids)))
                    held += size + 64
                if held > 16 * PACKED:
                    yield _batch(rows, PACK)
                    rows, held = [], 0
                now, start, ids, size = node, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if ids:
            yield _batch([*rows, (*now, start, ",".join(ids))], PACK)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, sha = [], None, None
        for node, ids in runs(batches, ["ids"]):
            if node != now:
                if sha:
                    rows.append((*now, sha.hexdigest()))
                if len(rows) >= 10_000:
                    yield _batch(rows, DIGEST)
                    rows = []
                now, sha = node, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if sha:
            rows.append((*now, sha.hexdigest()))
        if rows:
            yield _batch(rows, DIGEST)

    ends = prefixes.where("ends = 1").select(*NODE, "c").repartitionByRange(parts, *NODE, "c").sortWithinPartitions(*NODE, "c")
    packed = ends.mapInArrow(pack, "depth long, k1 long, k2 long, start long, ids string")
    return packed.repartition(parts, *NODE).sortWithinPartitions(*NODE, "start").mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


PACK = pa.schema([*[(n, pa.int64()) for n in (*NODE, "start")], ("ids", pa.string())])
DIGEST = pa.schema([*[(n, pa.int64()) for n in NODE], ("ends_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def prefix_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: ``RESULTS``.

    A conversation ``c`` starts with the first ``h = crc32(c) % heads`` turns of the one that
    heads its family of ``family`` ids, and goes on with its own turns after the first ``h``.
    """
    return _retried(lambda *constants: _trie(conversations, family, heads, *constants))


def _retried(build: Callable[..., DataFrame]) -> DataFrame:
    for constants in ATTEMPTS[:-1]:
        try:
            return build(*constants)
        except Collision:
            continue
    return build(*ATTEMPTS[-1])


def _trie(conversations: DataFrame, family: int, heads: int, b1: int, b2: int, seed: int) -> DataFrame:
    turns = turn_elements(conversations, seed)
    check_turns(turns)
    prefixes = rebuilt_prefixes(turns, family, heads, (b1, b2))
    nodes = trie_nodes(prefixes)
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("owner").alias("parent_conv_id"))
    parents = nodes.where("depth > 0").select(*NODE, "q1", "q2").join(parents, ["depth", "q1", "q2"]).select(*NODE, "parent_conv_id")
    nodes = nodes.join(subtree_sums(nodes, prefixes, (b1, b2)), NODE).join(member_digests(prefixes), NODE, "left").join(parents, NODE, "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return nodes.withColumn("conv_id", F.col("owner")).withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).select(*RESULTS)
