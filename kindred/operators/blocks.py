"""Block join: score many query rows against many candidate rows, keep the best k.

Both sides are packed into Arrow blocks of a few thousand rows, so that one
joined row is a pair of blocks and a kernel scores it with numpy.  No pair of
rows is ever a Spark row: a task emits at most k rows per query.

Both sides are counted and laid out on a grid of cells whose shape copies the
least data: few queries are copied to every column while each candidate moves once,
many queries make the grid square.  A task is one cell: it takes in the query blocks of
the cell, of which the grid gives it no more than fit its bound, and then meets each
candidate block once with all of them.  So a block is read and prepared once per cell, not
once per pair.  Memory per task stays at those blocks plus the running best lists, which
are flushed when they grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.session import task_count

QUERY_BLOCK_ROWS = 2048
CANDIDATE_BLOCK_ROWS = 512
RUNNING_ROWS = 2_000_000
#: Bytes of the query blocks that a task keeps prepared, in their numpy form.
PREPARED_BYTES = 160 << 20


class Kernel:
    """Scores one block of queries against one block of candidates."""

    #: Labels of several best lists that one scoring of a pair of blocks serves, if any.
    lists: list[str] | None = None

    def prepare(self, block: pa.Table, is_query: bool):
        """Numpy form of a block; kept for query blocks, which recur."""
        raise NotImplementedError

    def score(self, queries, candidates, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query index, candidate index, score)`` of all pairs that may rank, given
        the k-th best score each query has so far.

        With ``lists`` a query has one index per list: ``query * len(lists) + list``.
        """
        raise NotImplementedError

    #: Blocks of queries and of candidates are so many times as long as usual.
    longer: tuple[int, int] = (1, 1)

    def prepared_bytes(self, raw: float) -> float:
        """Bytes of a prepared query of ``raw`` bytes."""
        return 2.5 * raw


def pack_blocks(df: DataFrame, block_rows: int) -> DataFrame:
    """One row per block: a number ``nth`` that goes up evenly over all tasks, the block as Arrow stream bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId()

        def encode(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal nth
            nth += 1
            table = pa.Table.from_batches(parts).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            return pa.record_batch([pa.array([nth], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["nth", "block"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block_rows - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == block_rows:
                    yield encode(held)
                    held, rows = [], 0
        if held:
            yield encode(held)

    return df.mapInArrow(pack, "nth long, block binary")


def grid_shape(n_queries: int, n_candidates: int, cells: int, least_rows: int = 1) -> tuple[int, int]:
    """Rows and columns of a grid of about ``cells`` cells that copies the least data.

    Queries are copied once per column and candidates once per row.
    """
    rows = round((cells * n_queries / max(n_candidates, 1)) ** 0.5)
    rows = max(min(max(rows, 1), cells), least_rows)
    return rows, -(-cells // rows)


def on_grid(left: DataFrame, right: DataFrame, n_queries: int, n_candidates: int) -> DataFrame:
    """Every query block (``q_key``) beside every candidate block (``c_key``), cell by cell of a grid."""
    parts = task_count(left.sparkSession)
    rows, columns = grid_shape(n_queries, n_candidates, 2 * parts)
    row, column = F.pmod(F.xxhash64("q_key"), F.lit(rows)), F.pmod(F.xxhash64("c_key"), F.lit(columns))
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("at"))
    left = left.withColumn("cell", (row * columns + F.col("at")).cast("int")).drop("at").repartition(parts, "cell")
    right = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("at"))
    right = right.withColumn("cell", (F.col("at") * columns + column).cast("int")).drop("at").repartition(parts, "cell")
    return right.join(left, "cell")


def _raw_bytes(df: DataFrame) -> Column:
    """Bytes of a row's arrays and texts."""
    sizes = {T.ArrayType: lambda c: 8 * F.coalesce(F.size(c), F.lit(0)), T.StringType: lambda c: F.coalesce(F.length(c), F.lit(0))}
    return sum((sizes[type(f.dataType)](F.col(f.name)) for f in df.schema if type(f.dataType) in sizes), F.lit(8 * len(df.columns)))


def in_cells(queries: DataFrame, candidates: DataFrame, kernel: Kernel, sizes: tuple[int, int] | None = None) -> DataFrame:
    """``(cell, side, block)``: of every cell of the grid its query blocks (``side`` 0), then its candidate blocks.

    ``sizes`` are the row counts, where known.  A cell's queries take ``PREPARED_BYTES`` when prepared.
    """
    n_queries, raw = queries.agg(F.count(F.lit(1)), F.sum(_raw_bytes(queries).cast("double"))).first()
    n_candidates = sizes[1] if sizes else candidates.count()
    all_bytes = n_queries * kernel.prepared_bytes((raw or 0) / max(n_queries, 1))
    parts = task_count(queries.sparkSession)
    rows, columns = grid_shape(n_queries, n_candidates, 2 * parts, int(-(-all_bytes // PREPARED_BYTES)))
    left = pack_blocks(queries, QUERY_BLOCK_ROWS * kernel.longer[0])
    right = pack_blocks(candidates, CANDIDATE_BLOCK_ROWS * kernel.longer[1])
    row, column = F.pmod("nth", F.lit(rows)), F.pmod("nth", F.lit(columns))
    left = left.select(F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("at"), row.alias("row"), "block")
    right = right.select(F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("at"), column.alias("column"), "block")
    left = left.select((F.col("row") * columns + F.col("at")).cast("int").alias("cell"), F.lit(0).alias("side"), "block")
    right = right.select((F.col("at") * columns + F.col("column")).cast("int").alias("cell"), F.lit(1).alias("side"), "block")
    return left.unionByName(right).repartitionById(rows * columns, F.col("cell")).sortWithinPartitions("cell", "side")


def _held(ready) -> int:
    """Bytes of the arrays of a prepared block."""
    if isinstance(ready, dict):
        return sum(map(_held, ready.values()))
    return sum(map(_held, ready)) if isinstance(ready, (list, tuple)) else getattr(ready, "nbytes", 0)


def true_places(flags: np.ndarray, n: int) -> np.ndarray:
    """Places of the few true ones among the first ``n`` flags, eight at a time; there are eight more flags to write on."""
    flags[n : n + 8] = False
    eights = flags[: n + -n % 8].reshape(-1, 8)
    some = np.flatnonzero(eights.view(np.uint64).ravel())
    at, place = np.nonzero(eights[some])
    return 8 * some[at] + place


def _best(qi: np.ndarray, rid: np.ndarray, score: np.ndarray, k: int):
    """Best k per query, by score descending then row id."""
    order = np.lexsort((rid, -score, qi))
    qi, rid, score = qi[order], rid[order], score[order]
    starts = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]]) if len(qi) else np.empty(0, dtype=np.int64)
    rank = np.arange(len(qi)) - np.repeat(starts, np.diff(np.r_[starts, len(qi)]))
    keep = rank < k
    return qi[keep], rid[keep], score[keep]


def _floors(qi: np.ndarray, score: np.ndarray, queries: int, k: int) -> np.ndarray:
    """k-th best score so far; minus infinity while a query has fewer than k."""
    floor = np.full(queries, -np.inf)
    counts = np.bincount(qi, minlength=queries) if len(qi) else np.zeros(queries, dtype=np.int64)
    full = counts >= k
    lowest = np.full(queries, np.inf)
    np.minimum.at(lowest, qi, score)
    floor[full] = lowest[full]
    return floor


def top_matches(
    queries: DataFrame,
    candidates: DataFrame,
    kernel: Kernel,
    k: int,
    query_key: str = "query_id",
    key: str = "row_id",
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """``(query_key, key, score, rank)``: best k candidates of every query.

    A kernel with several lists gives the best k of each, told apart by ``list``.
    """
    return best_in_cells(in_cells(queries, candidates, kernel, sizes), kernel, k, query_key, key)


class _Best:
    """Best k candidates so far of every query of a block, and the k-th best score of each."""

    def __init__(self, ids: np.ndarray, several: int, k: int):
        self.ids, self.several, self.k = ids, several, k
        self.floor = np.full(len(ids) * several, -np.inf)
        self.empty()

    def empty(self) -> None:
        """Rows are handed on; what is below the k-th best of them cannot rank any more."""
        self.qi, self.rid, self.score = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
        self.new, self.waiting = [], 0

    def __len__(self) -> int:
        return len(self.qi) + self.waiting

    def add(self, qi: np.ndarray, rid: np.ndarray, score: np.ndarray) -> None:
        """Take in scored pairs; they are ranked once they are many beside the rows kept, or at once where one row is kept."""
        if len(qi):
            self.new.append((qi, rid, score))
            self.waiting += len(qi)
            if self.k == 1 or 2 * self.waiting > len(self.qi):
                self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        qi, rid, score = (np.concatenate(x) for x in zip(*self.new))
        self.new, self.waiting = [], 0
        touched = np.zeros(len(self.floor), dtype=bool)
        touched[qi] = True
        again = touched[self.qi]
        merged = _best(np.r_[self.qi[again], qi], np.r_[self.rid[again], rid], np.r_[self.score[again], score], self.k)
        np.maximum(self.floor, _floors(merged[0], merged[2], len(self.floor), self.k), out=self.floor)
        self.qi, self.rid, self.score = (np.r_[old[~again], new] for old, new in zip((self.qi, self.rid, self.score), merged))

    def rows(self, lists: list[str] | None, names: list[str]) -> pa.RecordBatch:
        self.settle()
        columns = [pa.array(self.ids[self.qi // self.several]), pa.array(self.rid), pa.array(self.score)]
        if lists:
            columns.append(pa.array(np.array(lists, dtype=object)[self.qi % self.several], pa.string()))
        return pa.record_batch(columns, names=names[: len(columns)])


def _ranked(partials: Iterator, pairs: DataFrame, kernel: Kernel, k: int, query_key: str, key: str) -> DataFrame:
    found = pairs.mapInArrow(partials, f"{query_key} long, {key} long, score double" + ", list string" * bool(kernel.lists))
    keys = [query_key, "list"] if kernel.lists else query_key
    return rank_within(found, keys, F.desc("score"), F.asc(key)).where(F.col("rank") <= k)


def _opened(block: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(block.as_buffer()).read_all()


def best_in_cells(cells: DataFrame, kernel: Kernel, k: int, query_key: str = "query_id", key: str = "row_id") -> DataFrame:
    """:func:`top_matches` of the blocks of :func:`in_cells`."""
    several, names = len(kernel.lists) if kernel.lists else 1, [query_key, key, "score", "list"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        cell = None

        def drain() -> Iterator[pa.RecordBatch]:
            for _, best in held:
                if len(best):
                    yield best.rows(kernel.lists, names)
                    best.empty()

        for batch in batches:
            for i in range(batch.num_rows):
                if (here := batch["cell"][i].as_py()) != cell:
                    yield from drain()
                    held, cell = [], here
                table = _opened(batch["block"][i])
                if batch["side"][i].as_py() == 0:
                    ids = table[query_key].to_numpy().copy()  # a view would hold the whole batch
                    held.append((kernel.prepare(table, True), _Best(ids, several, k)))
                    continue
                ready, rid = kernel.prepare(table, False), table[key].to_numpy()
                for asked, best in held:
                    qi, ci, score = kernel.score(asked, ready, best.floor)
                    best.add(qi, rid[ci], score)
                if sum(len(best) for _, best in held) > RUNNING_ROWS:
                    yield from drain()
        yield from drain()

    return _ranked(run, cells, kernel, k, query_key, key)


def best_of(pairs: DataFrame, kernel: Kernel, k: int, query_key: str = "query_id", key: str = "row_id") -> DataFrame:
    """:func:`top_matches` of pairs of blocks ``(q_key, q_block, c_block)``."""
    several, names = len(kernel.lists) if kernel.lists else 1, [query_key, key, "score", "list"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: dict[int, _Best] = {}
        prepared: dict[int, tuple] = {}
        kept: dict[int, int] = {}

        def drain() -> Iterator[pa.RecordBatch]:
            for best in running.values():
                if len(best):
                    yield best.rows(kernel.lists, names)
            running.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                q_key = batch["q_key"][i].as_py()
                if q_key not in prepared:
                    table = _opened(batch["q_block"][i])
                    made = (table[query_key].to_numpy().copy(), kernel.prepare(table, True))  # a view would hold the whole batch
                    size = _held(made)
                    while prepared and sum(kept.values()) + size > PREPARED_BYTES:
                        oldest = next(iter(prepared))
                        del prepared[oldest], kept[oldest]
                    kept[q_key], prepared[q_key] = size, made
                ids, ready = prepared[q_key]
                block = _opened(batch["c_block"][i])
                best = running[q_key] if q_key in running else _Best(ids, several, k)
                qi, ci, score = kernel.score(ready, kernel.prepare(block, False), best.floor)
                if not len(qi):
                    continue
                best.add(qi, block[key].to_numpy()[ci], score)
                running[q_key] = best
                if sum(len(r) for r in running.values()) > RUNNING_ROWS:
                    yield from drain()
        yield from drain()

    return _ranked(run, pairs, kernel, k, query_key, key)


def rank_within(df: DataFrame, query_key: str | list[str], *order: Column) -> DataFrame:
    """``rank`` from 1 within each query.

    A later ``rank <= k`` filter is pushed below the shuffle by Spark's window
    group limit, so only k rows per query and task are exchanged.
    """
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(query_key).orderBy(*order)))
