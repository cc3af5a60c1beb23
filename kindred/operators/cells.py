"""Exact best-k search by cosine that leaves most pairs unscored: pivots, rings, rounds.

A bounded, seeded set of candidates serves as pivots.  Every candidate belongs to the cell of its
nearest pivot, and blocks hold rows of one cell in order of their angle to it, so a block is a
ring.  By the triangle inequality on the sphere a query at angle t from the pivot is at least
``t - hi`` and ``lo - t`` away from all of a ring ``[lo, hi]``; rings that cannot reach the k-th
best score found so far are never scored.

Cells are met best first: the nearest few, then some more, then all others, and the k-th scores
of one round are written and given to the next.  Pairs of blocks that no query of a block can
need are left out by the join itself, before Python; inside a pair only the queries that need
the ring are multiplied.  Where vectors have no clusters nearly all pairs are scored, and the
rounds cost more than the plain grid; the README has figures.  Scores may differ from the grid's
at the last decimal kept, since products of other block shapes are summed in another order.

Defined cases: zero and NULL vectors score 0 against everything and form a cell of their own,
which is met only where 0 may still rank; queries with such a vector meet every cell; equal
scores go to the lower ``row_id``; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from kindred.operators.blocks import CANDIDATE_BLOCK_ROWS, QUERY_BLOCK_ROWS, Kernel, best_of, on_grid, rank_within, top_matches
from kindred.session import cut_lineage, task_count

#: Pivots: the square root of the candidates, within these bounds.
FEWEST_PIVOTS, MOST_PIVOTS = 16, 1024
#: Nearest cells that the first and the second round meet; the third meets all others.
ROUNDS = (4, 32)
#: Allowance for rounding in angles; it only ever adds pairs.
SLACK = 1e-7


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Angles to every pivot, and in a last column a right angle to the cell of zero vectors."""
    return np.hstack([np.arccos(np.clip(units @ pivots.T, -1.0, 1.0)), np.full((len(units), 1), np.pi / 2)])


def _reach(floor: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Largest angle at which a candidate may still rank; everything for zero vectors."""
    return np.where(zero, np.inf, np.arccos(np.clip(floor, -1.0, 1.0)) + SLACK)


def _met(near: np.ndarray, begin: int, end: int | None, cells: int) -> np.ndarray:
    """Cells that each query meets in the round of its ``begin``-th to ``end``-th nearest ones."""
    met = np.full((len(near), cells), end is None)
    rows = np.arange(len(near))[:, None]
    met[rows, near[:, :begin] if end is None else near[:, begin:end]] = end is not None
    return met


def _near(block: pa.Table) -> np.ndarray:
    lists = block["near"].combine_chunks()
    return lists.flatten().to_numpy().reshape(len(lists), -1)


class CellKernel(Kernel):
    """A cosine kernel for pairs of a query block and a ring, in one round."""

    def __init__(self, inner, pivots: np.ndarray, begin: int, end: int | None, scored: Accumulator | None):
        self.inner, self.pivots, self.begin, self.end, self.scored = inner, pivots, begin, end, scored

    def prepare(self, block: pa.Table, is_query: bool) -> dict:
        ready = {"inner": self.inner.prepare(block, is_query)}
        if not is_query:
            angles = block["angle"].to_numpy()
            return ready | {"cell": block["home"][0].as_py(), "lo": angles.min(), "hi": angles.max()}
        units = self.inner.units(block)
        met = _met(_near(block), self.begin, self.end, len(self.pivots) + 1)
        return ready | {"units": units, "zero": ~units.any(axis=1), "met": met, "floor": block["floor"].to_numpy()}

    def score(self, q: dict, c: dict, floor: np.ndarray):
        floor = np.fmax(floor, q["floor"])
        cell = c["cell"]
        away = np.full(len(floor), np.pi / 2)
        if cell < len(self.pivots):
            away = np.arccos(np.clip(q["units"] @ self.pivots[cell], -1.0, 1.0))
        reach = _reach(floor, q["zero"])
        rows = np.flatnonzero(q["met"][:, cell] & (away - reach <= c["hi"]) & (away + reach >= c["lo"]))
        if not len(rows):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
        if self.scored is not None:
            self.scored.add(len(rows) * len(c["inner"]["norm"]))
        qi, ci, score = self.inner.score(self.inner.take(q["inner"], rows), c["inner"], floor[rows])
        return rows[qi], ci, score


def _pivots(candidates: DataFrame, kernel, n: int) -> np.ndarray:
    """Distinct unit vectors of the rows of smallest hash, at most ``MOST_PIVOTS``."""
    wanted = min(max(int(n**0.5), FEWEST_PIVOTS), MOST_PIVOTS)
    block = candidates.orderBy(F.xxhash64("row_id"), "row_id").limit(wanted).toArrow()
    units = kernel.units(block)
    return np.unique(units[units.any(axis=1)], axis=0)


def _placed_candidates(candidates: DataFrame, kernel, pivots: np.ndarray) -> DataFrame:
    """Rows with their cell ``home`` and their ``angle`` to its pivot."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = kernel.units(pa.Table.from_batches([batch]))
            angles = _angles(units, pivots)
            home = np.where(units.any(axis=1), angles[:, :-1].argmin(axis=1), len(pivots))
            angle = np.where(home < len(pivots), angles[np.arange(len(home)), home], 0.0)
            columns = [*batch.columns, pa.array(home, pa.int32()), pa.array(angle)]
            yield pa.record_batch(columns, names=[*batch.schema.names, "home", "angle"])

    return candidates.mapInArrow(place, StructType([*candidates.schema, StructField("home", IntegerType()), StructField("angle", DoubleType())]))


def _placed_queries(queries: DataFrame, kernel, pivots: np.ndarray) -> DataFrame:
    """Queries with their nearest cells ``near``, nearest first; written, so that all rounds agree."""
    kept = min(ROUNDS[-1], len(pivots) + 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = _angles(kernel.units(pa.Table.from_batches([batch])), pivots)
            near = np.argsort(angles, axis=1, kind="stable")[:, :kept].astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, near.size + 1, kept, dtype=np.int32), near.ravel())
            yield pa.record_batch([*batch.columns, lists], names=[*batch.schema.names, "near"])

    return queries.mapInArrow(place, StructType([*queries.schema, StructField("near", ArrayType(IntegerType()))]))


def _blocks(batches: Iterator[pa.RecordBatch], size: int, by: str | None = None) -> Iterator[pa.Table]:
    """Tables of at most ``size`` rows; rows arrive in order of ``by``, of which a table holds one value."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch[by].to_numpy() if by else np.zeros(batch.num_rows)
        bounds = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1), batch.num_rows]
        for start, stop in zip(bounds, bounds[1:]):
            part = batch.slice(start, stop - start)
            if held and by and held[-1][by][0] != part[by][0]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            while part.num_rows:
                piece = part.slice(0, size - sum(h.num_rows for h in held))
                part = part.slice(piece.num_rows)
                held.append(piece)
                if sum(h.num_rows for h in held) == size:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _rings(placed: DataFrame) -> DataFrame:
    """Blocks of one cell and neighbouring angles: ``(c_key, home, lo, hi, c_block)``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, CANDIDATE_BLOCK_ROWS, "home"):
            angles = table["angle"].to_numpy()
            row = [table["row_id"][0].as_py(), table["home"][0].as_py(), angles.min(), angles.max(), _stream(table)]
            types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary()]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, types)], names=["c_key", "home", "lo", "hi", "c_block"])

    ordered = placed.repartitionByRange(task_count(placed.sparkSession), "home", "angle", "row_id").sortWithinPartitions("home", "angle", "row_id")
    return ordered.mapInArrow(pack, "c_key long, home int, lo double, hi double, c_block binary")


def _query_blocks(queries: DataFrame, kernel, pivots: np.ndarray, begin: int, end: int | None) -> DataFrame:
    """Blocks of queries with near cells in common, and the angles ``least`` to ``most`` they need of every cell."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, QUERY_BLOCK_ROWS):
            units = kernel.units(table)
            angles, reach = _angles(units, pivots), _reach(table["floor"].to_numpy(), ~units.any(axis=1))[:, None]
            met = _met(_near(table), begin, end, len(pivots) + 1)
            least = np.where(met, angles - reach, np.inf).min(axis=0)
            most = np.where(met, angles + reach, -np.inf).max(axis=0)
            row = [table["query_id"][0].as_py(), least, most, _stream(table)]
            types = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, types)], names=["q_key", "least", "most", "q_block"])

    first = F.element_at("near", 1)
    ordered = queries.repartitionByRange(task_count(queries.sparkSession), first, "query_id").sortWithinPartitions(first, "query_id")
    return ordered.mapInArrow(pack, "q_key long, least array<double>, most array<double>, q_block binary")


def cell_matches(
    queries: DataFrame, candidates: DataFrame, kernel, k: int, sizes: tuple[int, int], scored: Accumulator | None = None
) -> DataFrame:
    """``(query_id, row_id, score, rank)``, the rows of :func:`blocks.top_matches`.

    ``scored`` counts the pairs that were multiplied.
    """
    pivots = _pivots(candidates, kernel, sizes[1])
    if not len(pivots):
        return top_matches(queries, candidates, kernel, k, sizes=sizes)
    rings = cut_lineage(_rings(_placed_candidates(candidates, kernel, pivots)))
    asked = cut_lineage(_placed_queries(queries, kernel, pivots))
    least = F.col("min_similarity") if "min_similarity" in queries.columns else F.lit(None).cast("double")
    floor, best = asked.select("query_id", F.coalesce(least, F.lit(float("-inf"))).alias("floor")), None
    for begin, end in zip((0, *ROUNDS), (*ROUNDS, None)):
        blocks = _query_blocks(asked.join(floor, "query_id"), kernel, pivots, begin, end)
        met = on_grid(blocks, rings, *sizes)
        met = met.where((F.col("hi") >= F.get("least", "home")) & (F.col("lo") <= F.get("most", "home")))
        found = best_of(met.select("q_key", "q_block", "c_block"), CellKernel(kernel, pivots, begin, end, scored), k)
        if best is not None:
            found = rank_within(best.drop("rank").union(found.drop("rank")), "query_id", F.desc("score"), F.asc("row_id")).where(F.col("rank") <= k)
        best = cut_lineage(found)
        full = best.where(F.col("rank") == k).select("query_id", "score")
        floor = asked.join(full, "query_id", "left").select(
            "query_id", F.greatest(least, "score", F.lit(float("-inf"))).alias("floor")
        )
    return best


def pruned_matches(queries: DataFrame, candidates: DataFrame, kernel, k: int) -> DataFrame:
    """:func:`cell_matches` of any two tables, which are written and counted first."""
    queries, candidates = cut_lineage(queries), cut_lineage(candidates)
    return cell_matches(queries, candidates, kernel, k, (queries.count(), candidates.count()))
