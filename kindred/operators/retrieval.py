"""Cosine retrieval: similar, within budget, undervalued, by description.

Profiles carry ``row_id, player, pos, market_value_eur`` and one or more vector
blocks.  A blend of blocks is described by ``{column: weight}``; the blended
cosine is computed from the blocks at score time, so one stored copy of the
vectors serves every weight.  Scores are fixed to 12 decimals before ranking,
so that equal vectors tie exactly and ``row_id`` decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.columns import as_double
from kindred.functions.constants import BROAD_POSITIONS
from kindred.functions.positions import broad_group, contains_code
from kindred.operators.blocks import Kernel, rank_within, top_matches, true_places
from kindred.operators.cells import pruned_matches
from kindred.session import shuffled

Weights = dict[str, float]
SCORE_DECIMALS = 12
#: Most that a product of unit vectors in single precision may be off, and pairs scored exactly at a time.
NEAR_SLACK, EXACT_PAIRS = 1e-4, 16_384
#: Pairs multiplied at a time, so that the products stay in a core's cache.
NEAR_PAIRS = 1 << 18

# Optional per-query limits the kernel understands, with the candidate column each reads.
LIMITS = {
    "exclude_row_id": None,
    "want_pos": "pos",
    "want_group": "pos_group",
    "max_value": "value",
    "want_flag": "flag",
    "min_similarity": None,
}


def stat_text_weights(alpha: float, stat: str = "stat", text: str = "text") -> Weights:
    """Weights of the two blocks; 1 is pure statistics, 0 pure text."""
    if not 0.0 <= alpha <= 1.0:
        raise ValueError(f"alpha must be in [0, 1], got {alpha}")
    return {stat: alpha, text: 1.0 - alpha}


# ------------------------------------------------------------------- the kernel


def _floats(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy()


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Dense float64 matrix of a list column; missing lists are zero rows."""
    lists = column.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    width = int(lengths.max()) if len(lengths) else 0
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.nan_to_num(values, nan=0.0)
    if len(values) == len(lengths) * width:
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _codes(values: list) -> tuple[list, np.ndarray]:
    distinct = sorted({v for v in values if v is not None})
    index = {v: i for i, v in enumerate(distinct)}
    return distinct, np.array([index.get(v, -1) for v in values], dtype=np.int64)


def _upper_codes(column: pa.ChunkedArray) -> tuple[list, np.ndarray]:
    return _codes([v and v.upper() for v in column.to_pylist()])


def _held_groups(q: dict, c: dict) -> np.ndarray:
    """Number among the wanted groups of each group code of the candidates, -2 where nobody wants it."""
    wanted = {g: i for i, g in enumerate(q["want_group"][0])}
    return np.array([wanted.get(g, -2) for g in c["pos_group"][0]] + [-2])


def _same_group(q: dict, c: dict) -> np.ndarray:
    return (q["want_group"][1][:, None] == _held_groups(q, c)[c["pos_group"][1]][None, :]) | (q["want_group"][1] < 0)[:, None]


def _code_table(q: dict, c: dict) -> np.ndarray:
    """Whether each position holds each wanted code; nothing wanted is held by all."""
    return np.array([[code in pos for pos in c["pos"][0]] + [False] for code in q["want_pos"][0]] + [[True] * (len(c["pos"][0]) + 1)])


def _holds_code(q: dict, c: dict) -> np.ndarray:
    return _code_table(q, c)[q["want_pos"][1]][:, c["pos"][1]]


class CosineKernel(Kernel):
    """Blended cosine under the per-query limits."""

    def __init__(self, weights: Weights, k: int, nulls_pass: bool = True):
        self.weights, self.k, self.nulls_pass = weights, k, nulls_pass

    def units(self, block: pa.Table) -> np.ndarray:
        """Blended vectors of a block at unit length; zero vectors stay zero."""
        rows = np.hstack([_matrix(block[c]) * w for c, w in self.weights.items()])
        norm = np.sqrt((rows * rows).sum(axis=1))
        return rows / np.where(norm > 0, norm, 1.0)[:, None]

    @staticmethod
    def take(ready: dict, rows: np.ndarray) -> dict:
        """Some queries of a prepared block."""
        return {n: (v[0], v[1][rows]) if isinstance(v, tuple) else v[rows] for n, v in ready.items()}

    def prepare(self, block: pa.Table, is_query: bool) -> dict:
        ready = {c: _matrix(block[c]) * w for c, w in self.weights.items()}
        norm = np.sqrt(sum((m * m).sum(axis=1) for m in ready.values()))
        if not self.lists:
            ready["unit"] = _units([_single(ready[c], norm) for c in self.weights])
        ready["norm"] = norm
        names = set(block.column_names)
        readers = {
            "want_pos": _upper_codes, "pos": _upper_codes,
            "want_group": lambda x: _codes(x.to_pylist()), "pos_group": lambda x: _codes(x.to_pylist()),
            "exclude_row_id": lambda x: np.asarray(pc.fill_null(x, -1)), "row_id": lambda x: x.to_numpy(),
            "max_value": _floats, "value": _floats, "min_similarity": _floats,
            "want_flag": lambda x: np.array([bool(v) for v in x.to_pylist()]),
            "flag": lambda x: np.array([v == 1 for v in x.to_pylist()]),
        }
        ready.update({n: read(block[n]) for n, read in readers.items() if n in names})
        return ready

    def _allowed(self, q: dict, c: dict) -> np.ndarray | None:
        masks = []
        if "want_pos" in q:
            masks.append(_holds_code(q, c))
        if "want_group" in q:
            masks.append(_same_group(q, c))
        if "max_value" in q:
            cap, value = q["max_value"], c["value"]
            within = value[None, :] <= cap[:, None]
            if self.nulls_pass:
                within |= np.isnan(value)[None, :]
            masks.append(within | np.isnan(cap)[:, None])
        if "want_flag" in q:
            masks.append(c["flag"][None, :] | ~q["want_flag"][:, None])
        return np.logical_and.reduce(masks) if masks else None

    def _permits(self, q: dict, c: dict, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
        """:meth:`_allowed` of listed pairs."""
        permitted = np.ones(len(qi), dtype=bool)
        if "want_pos" in q:
            permitted &= _code_table(q, c)[q["want_pos"][1][qi], c["pos"][1][ci]]
        if "want_group" in q:
            wanted = q["want_group"][1][qi]
            permitted &= (wanted == _held_groups(q, c)[c["pos_group"][1][ci]]) | (wanted < 0)
        if "max_value" in q:
            cap, value = q["max_value"][qi], c["value"][ci]
            permitted &= (value <= cap) | np.isnan(cap) | (self.nulls_pass & np.isnan(value))
        if "want_flag" in q:
            permitted &= c["flag"][ci] | ~q["want_flag"][qi]
        return permitted

    def score(self, q: dict, c: dict, floor: np.ndarray):
        return self._ranking(q, c, (q["norm"], c["norm"]), (q["unit"], c["unit"]), dict.fromkeys(self.weights, 1.0), floor)

    def _ranking(self, q, c, norms, units, squares: Weights, floor: np.ndarray):
        """Pairs that may rank: single-precision products leave out what cannot, the rest is scored in double precision."""
        limit = np.fmax(floor, q["min_similarity"]) if "min_similarity" in q else floor
        used = [b for b in squares if q[b].shape[1] and c[b].shape[1]]
        unsure = any(_extreme(n).any() for n in norms)
        limits = {n: q[n] for n in ("want_pos", "want_group", "max_value", "want_flag") if n in q}
        own = np.flatnonzero(np.isin(c["row_id"], q["exclude_row_id"])) if "exclude_row_id" in q else []
        least, wide = np.fmax(limit - NEAR_SLACK, -2.0).astype(np.float32), len(norms[1])
        narrowed = wide > self.k and not unsure  # what is below the k-th by twice the slack cannot rank
        step = max(1, NEAR_PAIRS // max(wide, 1))
        flags = np.empty(step * wide + 8, dtype=bool)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for start in range(0, len(limit), step):
            rows = slice(start, start + step)
            near = _products(units[0], units[1], rows)
            if unsure:
                np.nan_to_num(near, copy=False, nan=2.0)
            if len(own):
                near[:, own] = np.where(c["row_id"][own] == q["exclude_row_id"][rows, None], -np.inf, near[:, own])
            fresh = np.flatnonzero(least[rows] <= -2.0) if narrowed else []
            if len(fresh):  # queries without a floor yet
                part = near[fresh]
                if limits:
                    np.copyto(part, -np.inf, where=~self._allowed(self.take(limits, start + fresh), c))
                    near[fresh] = part
                least[start + fresh] = np.fmax(np.partition(part, wide - self.k, axis=1)[:, wide - self.k] - 2 * NEAR_SLACK, -2.0)
            np.greater_equal(near, least[rows, None], out=flags[: near.size].reshape(near.shape))
            qi, ci = np.divmod(true_places(flags, near.size), max(wide, 1))
            if limits and len(qi):
                kept = self._permits(q, c, start + qi, ci)
                qi, ci = qi[kept], ci[kept]
            many = np.bincount(qi, minlength=len(near)) > 4 * self.k
            if narrowed and many.any():
                of, at = np.cumsum(many) - 1, many[qi]
                ranked = np.full((int(many.sum()), wide), -np.inf, np.float32)
                ranked[of[qi[at]], ci[at]] = near[qi[at], ci[at]]
                kth = np.partition(ranked, wide - self.k, axis=1)[:, wide - self.k] - np.float32(2 * NEAR_SLACK)
                at[at] = near[qi[at], ci[at]] < kth[of[qi[at]]]
                qi, ci = qi[~at], ci[~at]
            found.append((start + qi, ci))
        qi, ci = (np.concatenate(x) for x in zip(*found))
        score = np.empty(len(qi))
        for start in range(0, len(qi), EXACT_PAIRS):
            at = slice(start, start + EXACT_PAIRS)
            scale = norms[0][qi[at]] * norms[1][ci[at]]
            dots = sum((squares[b] * np.einsum("ij,ij->i", q[b][qi[at]], c[b][ci[at]]) for b in used), np.zeros(len(scale)))
            score[at] = np.divide(dots, scale, out=np.zeros_like(scale), where=scale > 0)
        np.round(score, SCORE_DECIMALS, out=score)
        kept = (score >= limit[qi]) & (score > -np.inf)
        return qi[kept], ci[kept], score[kept]


def _extreme(norm: np.ndarray) -> np.ndarray:
    """Lengths whose products may leave the range of doubles: such rows are always scored exactly."""
    return ~((norm == 0) | (norm > 1e-100) & (norm < 1e100))


def _single(rows: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Rows over their length in single precision; those of extreme length are NaN."""
    unit = (rows / np.where(norm > 0, norm, 1.0)[:, None]).astype(np.float32)
    unit[_extreme(norm)] = np.nan
    return unit


def _units(parts: list[np.ndarray]) -> tuple[tuple[int, ...], np.ndarray]:
    """Unit blocks side by side, with their widths."""
    return tuple(p.shape[1] for p in parts), np.hstack(parts)


def _products(q: tuple, c: tuple, rows: slice) -> np.ndarray:
    """Products of some queries with all candidates; a block that one side has not adds nothing."""
    if q[0] == c[0]:
        return q[1][rows] @ c[1].T
    near, (a, b) = np.zeros((len(q[1][rows]), len(c[1])), np.float32), (np.cumsum([0, *side[0]]) for side in (q, c))
    for i in np.flatnonzero(np.minimum(q[0], c[0])):
        near += q[1][rows, a[i] : a[i + 1]] @ c[1][:, b[i] : b[i + 1]].T
    return near


class VariantKernel(CosineKernel):
    """One best list per variant of weights; a pair of blocks is multiplied once for all."""

    def __init__(self, variants: dict[str, Weights], k: int, nulls_pass: bool = True):
        self.blocks = list(dict.fromkeys(b for weights in variants.values() for b in weights))
        super().__init__(dict.fromkeys(self.blocks, 1.0), k, nulls_pass)
        self.lists = list(variants)
        self.squares = [{b: w * w for b, w in weights.items()} for weights in variants.values()]

    def prepare(self, block: pa.Table, is_query: bool) -> dict:
        ready = super().prepare(block, is_query)
        own = {b: (ready[b] * ready[b]).sum(axis=1) for b in self.blocks}
        ready["norms"] = [np.sqrt(sum(w * own[b] for b, w in squares.items())) for squares in self.squares]
        ready["units"] = [
            _units([_single(ready[b] * np.sqrt(w), norm) for b, w in squares.items()]) for squares, norm in zip(self.squares, ready["norms"])
        ]
        return ready

    def score(self, q: dict, c: dict, floor: np.ndarray):
        found = []
        for at, squares in enumerate(self.squares):
            norms, units = (q["norms"][at], c["norms"][at]), (q["units"][at], c["units"][at])
            qi, ci, score = self._ranking(q, c, norms, units, squares, floor[at :: len(self.lists)])
            found.append((qi * len(self.lists) + at, ci, score))
        return tuple(np.concatenate(x) for x in zip(*found))


def nearest(
    profiles: DataFrame,
    queries: DataFrame,
    weights: Weights | dict[str, Weights],
    k: int,
    nulls_pass: bool = True,
    flag_col: str = "is_world_cup",
    method: str = "grid",
) -> DataFrame:
    """``(query_id, row_id, score, rank)`` for queries that already hold vectors.

    ``method`` is ``grid`` (all pairs of blocks) or ``cells`` (pivot bounds leave pairs out, with
    the same rows).  Labelled weights always take the grid.

    Labelled weights give one list per label, in column ``list``, by one pass over the pairs.

    Any column of ``LIMITS`` present in ``queries`` is applied per query.  Only
    the columns the kernel reads are taken from the profiles.
    """
    if method not in ("grid", "cells"):
        raise ValueError(f"unknown method {method!r}")
    several = all(isinstance(w, dict) for w in weights.values())
    kernel = (VariantKernel if several else CosineKernel)(weights, k, nulls_pass)
    weights = kernel.weights
    used = [c for c in LIMITS if c in queries.columns]
    readers: dict[str, Column] = {
        "pos": F.col("pos") if "pos" in profiles.columns else F.lit(None).cast("string"),
        "pos_group": F.col("pos_group") if "pos_group" in profiles.columns else broad_group(F.coalesce("pos", F.lit(""))),
        "value": as_double("market_value_eur") if "market_value_eur" in profiles.columns else F.lit(None).cast("double"),
        "flag": F.col(flag_col) if flag_col in profiles.columns else F.lit(None).cast("int"),
    }
    needed = [LIMITS[c] for c in used if LIMITS[c]]
    candidates = profiles.select("row_id", *weights, *[readers[n].alias(n) for n in needed])
    block = queries.select("query_id", *weights, *used)
    search = pruned_matches if method == "cells" and not several else top_matches
    return search(block, candidates, kernel, k)


# ------------------------------------------------------------------- result shape


def with_query_profile(queries: DataFrame, profiles: DataFrame, columns: list[str]) -> DataFrame:
    """Queries ``(query_id, row_id, …)`` with columns of their own profile."""
    return queries.join(shuffled(profiles.select("row_id", *columns)), "row_id")


def describe(matches: DataFrame, profiles: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Join profile columns back, round the similarity (half-even, 4 decimals)."""
    columns = columns if columns is not None else [c for c in ["player", "pos", "squad", "league"] if c in profiles.columns]
    out = matches.join(shuffled(profiles.select("row_id", *columns)), "row_id")
    out = out.withColumn("similarity", F.bround("score", 4)).drop("score")
    if "pos" in columns and "position" not in out.columns:
        out = out.withColumn("position", F.col("pos"))
    return out


# ------------------------------------------------------------------------- modes


def find_similar(
    profiles: DataFrame,
    queries: DataFrame,
    weights: Weights,
    k: int = 10,
    position_filter: str | None = None,
    columns: list[str] | None = None,
    method: str = "grid",
) -> DataFrame:
    """Mode 1.  ``queries(query_id, row_id[, want_pos])``; the query itself is left out.

    ``method`` as in :func:`nearest`.  A fixed ``position_filter`` is an ordinary filter on the profile scan; a
    ``want_pos`` column restricts each query on its own.
    """
    block = with_query_profile(queries, profiles, list(weights)).withColumn("exclude_row_id", F.col("row_id"))
    pool = profiles if position_filter is None else profiles.where(contains_code(F.col("pos"), position_filter))
    return describe(nearest(pool, block, weights, k, method=method), profiles, columns)


class Variants:
    """Mode 1 under several weights at once: ``(query_id, rank, player, embedding_type)`` for ``queries(query_id, row_id)``."""

    def __init__(self, profiles: DataFrame, variants: dict[str, Weights]):
        self.profiles, self.variants, self.labels = profiles, variants, list(variants)

    def __call__(self, queries: DataFrame, k: int) -> DataFrame:
        blocks = list(dict.fromkeys(b for weights in self.variants.values() for b in weights))
        asked = with_query_profile(queries, self.profiles, blocks).withColumn("exclude_row_id", F.col("row_id"))
        found = nearest(self.profiles, asked, self.variants, k)
        return describe(found, self.profiles, ["player"]).withColumnRenamed("list", "embedding_type")


def find_budget_replacement(
    profiles: DataFrame,
    queries: DataFrame,
    weights: Weights,
    k: int = 5,
    same_position: bool = True,
    rules: list[tuple[str, list[str]]] = BROAD_POSITIONS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Mode 2.  ``queries(query_id, row_id, budget)``; an unknown value is within budget."""
    pool = profiles.withColumn("pos_group", broad_group(F.coalesce("pos", F.lit("")), rules))
    block = with_query_profile(queries, pool, [*weights, "pos_group"])
    block = block.withColumn("exclude_row_id", F.col("row_id")).withColumn("max_value", as_double("budget"))
    if same_position:
        block = block.withColumn("want_group", F.col("pos_group"))
    return describe(nearest(pool, block, weights, k, nulls_pass=True), profiles, columns)


def position_centroids(profiles: DataFrame, codes: DataFrame, weights: Weights) -> DataFrame:
    """Mean vector blocks of all rows whose position contains each ``code``.

    Vectors are summed per distinct position string first (map-side combined);
    only that small table meets the codes.
    """
    sums = profiles.where(F.col("pos").isNotNull()).groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"),
        *[Summarizer.sum(array_to_vector(F.col(c).cast("array<double>"))).alias(c) for c in weights],
    )
    per_code = codes.select("code").distinct().join(sums, contains_code(F.col("pos"), F.col("code")))
    total = per_code.groupBy("code").agg(
        F.sum("n").alias("n_rows"), *[Summarizer.sum(F.col(c)).alias(c) for c in weights]
    )
    means = [F.transform(vector_to_array(c), lambda x: x / F.col("n_rows")).alias(c) for c in weights]
    return total.select("code", "n_rows", *means)


def find_hidden_gems(
    profiles: DataFrame,
    targets: DataFrame,
    weights: Weights,
    min_similarity: float = 0.5,
    k: int = 5,
    columns: list[str] | None = None,
) -> DataFrame:
    """Mode 3.  ``targets(query_id, position, max_value[, row_id])``.

    With a ``row_id`` column the reference profile is the query and is left
    out of its own result; without it the centroid of the position is used and
    nothing is left out.  An unknown value never qualifies.
    """
    targets = targets.withColumn("want_pos", F.col("position")).withColumn("min_similarity", F.lit(min_similarity))
    if "row_id" in targets.columns:
        block = with_query_profile(targets, profiles, list(weights)).withColumn("exclude_row_id", F.col("row_id"))
    else:
        centroids = position_centroids(profiles, targets.select(F.col("position").alias("code")), weights)
        block = targets.join(centroids.drop("n_rows").withColumnRenamed("code", "position"), "position")
    pool = profiles.where(as_double("market_value_eur").isNotNull())
    return describe(nearest(pool, block, weights, k, nulls_pass=False), profiles, columns)


def description_search(
    profiles: DataFrame,
    requests: DataFrame,
    text_col: str = "text",
    k: int = 10,
    columns: list[str] | None = None,
) -> DataFrame:
    """Mode 4.  ``requests(query_id, <text_col>[, want_pos, max_value, want_flag])``.

    The description vector is compared with the text block of every profile;
    all limits hold before the cut and an unknown value fails a value limit.
    """
    return describe(nearest(profiles, requests, {text_col: 1.0}, k, nulls_pass=False), profiles, columns)


# ----------------------------------------------------------- after the first cut


def blend_rerank(results: DataFrame, text_scores: DataFrame, share: float = 0.6) -> DataFrame:
    """Re-rank a cut list by ``share * similarity + (1 - share) * text_score``.

    ``text_scores(query_id, row_id, text_score)``; a row without a text score
    keeps its similarity.  Equal scores go by ``row_id``.
    """
    mixed = F.bround(F.lit(share) * F.col("similarity") + F.lit(1.0 - share) * F.col("text_score"), 4)
    out = results.join(shuffled(text_scores), ["query_id", "row_id"], "left")
    out = out.withColumn("similarity", F.coalesce(mixed, "similarity")).drop("text_score", "rank")
    return rank_within(out, "query_id", F.desc("similarity"), F.asc("row_id"))


def pair_scores(pairs: DataFrame, query_vectors: DataFrame, profiles: DataFrame, column: str, score: Column) -> DataFrame:
    """Score of listed ``(query_id, row_id)`` pairs only, by two key joins."""
    q = query_vectors.select("query_id", F.col(column).alias("q_vec"))
    c = profiles.select("row_id", F.col(column).alias("c_vec"))
    return pairs.join(shuffled(q), "query_id").join(shuffled(c), "row_id").select("query_id", "row_id", score.alias("text_score"))


def first_shown(results: DataFrame, keep: Column, shown: int = 5) -> DataFrame:
    """Filter a cut list afterwards and show the first few; ranks stay as they were."""
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
    return results.where(keep).withColumn("_shown", order).where(F.col("_shown") <= shown).drop("_shown")


def chart_rows(results: DataFrame, shown: int = 10) -> DataFrame:
    """Plotted columns: value in millions with a missing value as 0, first rows by rank."""
    return first_shown(results, F.lit(True), shown).withColumn(
        "value_millions", F.coalesce(as_double("market_value_eur"), F.lit(0.0)) / 1e6
    )
