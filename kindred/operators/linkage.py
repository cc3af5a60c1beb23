"""Linking tables whose names are spelled differently.

``best_sorted_matches`` finds, for every left text, its best right text under
token-sorted indel similarity, in three exact steps:

1. equal token-sorted texts, by hash join (score 100);
2. texts at least ``NEAR`` similar, by a join on text segments: a right text
   cut into ``d + 1`` pieces shares at least one piece with any text within
   ``d`` insertions and deletions, so only equal pieces meet;
3. the texts still open, by an inverted index of positional bigrams (module
   ``grams``) or, where bigrams tell too little, by the block join with a
   letter-count bound that skips every pair which cannot reach the threshold.

A text settled in an earlier step never enters a later one, since each step
finds all pairs above its own score.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import fuzzy
from kindred.functions.columns import present_columns
from kindred.functions.constants import VALUE_METADATA
from kindred.functions.text import fold_name, match_key, sorted_tokens, token_name_score
from kindred.operators.blocks import Kernel, rank_within, top_matches, true_places
from kindred.operators.grams import LEAST_THRESHOLD, GramIndex, matches_per_pair
from kindred.session import cut_lineage, numbered, shuffled, spread

NEAR = 95.0
SPARE_SEGMENTS = 2
#: Letters of a piece below which no spare pieces are cut: shorter ones meet too many texts.
LEAST_PIECE = 6
SLACK = 1e-9
#: Pairs that the block join settles in the time of one match of the bigram index.
MATCH_COST = 10
#: Pairs of a query that are scored before its bounds are looked at again.
FIRST_BATCH = 4

# ------------------------------------------------------------- segment candidates


def _length_range(n: Column, t: float) -> tuple[Column, Column]:
    """Shortest and longest partner of a text of length ``n`` at threshold ``t``."""
    grow = (200.0 - t) / t
    return F.ceil(n / grow - SLACK).cast("int"), F.floor(n * grow + SLACK).cast("int")


def _edits(total: Column, t: float) -> Column:
    """Most insertions plus deletions two texts of this total length may differ by."""
    return F.floor(total * (1.0 - t / 100.0) + SLACK).cast("int")


def _pieces(n: Column, t: float) -> Column:
    """Number of pieces a right text of length ``n`` is cut into."""
    needed = _edits(n + _length_range(n, t)[1], t) + 1
    spare = F.least(F.lit(SPARE_SEGMENTS), F.floor(n / LEAST_PIECE).cast("int") - needed)
    return F.least(n, needed + F.greatest(spare, F.lit(0)))


def _piece_start(n: Column, m: Column, i: Column) -> Column:
    """Zero-based start of piece ``i``; the last ``n % m`` pieces are one longer."""
    return (i * F.floor(n / m) + F.greatest(F.lit(0), i - (m - n % m))).cast("int")


def _piece_length(n: Column, m: Column, i: Column) -> Column:
    return (F.floor(n / m) + F.when(i >= m - n % m, 1).otherwise(0)).cast("int")


def right_segments(right: DataFrame, t: float) -> DataFrame:
    """``(r_text, seg)`` index rows without the commonest pieces of each text.

    Each text has up to ``SPARE_SEGMENTS`` pieces more than needed, so that many of
    its pieces are left out without losing a partner.
    """
    n = F.length("r_text")
    m = _pieces(n, t)
    spare = m - (_edits(n + _length_range(n, t)[1], t) + 1)
    cut = right.where(n > 0).select("r_text", n.alias("n"), m.alias("m"), F.greatest(spare, F.lit(0)).alias("spare"))
    rows = cut.select("r_text", "n", "m", "spare", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i"))
    piece = F.substring(
        "r_text", _piece_start(F.col("n"), F.col("m"), F.col("i")) + 1, _piece_length(F.col("n"), F.col("m"), F.col("i"))
    )
    rows = rows.select("r_text", "spare", F.xxhash64("n", "i", piece).alias("seg"))
    marked = rows.join(shuffled(rows.groupBy("seg").agg(F.count(F.lit(1)).alias("hits"))), "seg")
    commonest = F.row_number().over(Window.partitionBy("r_text").orderBy(F.desc("hits"), "seg"))
    return marked.withColumn("nth", commonest).where(F.col("nth") > F.col("spare")).select("r_text", "seg")


def left_segments(left: DataFrame, t: float, sizes: DataFrame) -> DataFrame:
    """``(l_text, seg)`` probes: every substring that could equal a right piece.

    A piece may be shifted by ``s`` only if ``|s| + |s - (a - b)|`` edits are
    allowed, where a and b are the two lengths.  ``sizes(n)`` are the lengths of right texts.
    """
    a = F.length("l_text")
    low, high = _length_range(a, t)
    by_length = left.where(a > 0).select("l_text", a.alias("a"), F.explode(F.sequence(low, high)).alias("n"))
    by_length = by_length.join(sizes, "n").withColumn("m", _pieces(F.col("n"), t)).where(F.col("n") > 0)
    d = _edits(F.col("a") + F.col("n"), t)
    gap = F.col("a") - F.col("n")
    by_piece = by_length.where(F.abs(gap) <= d).select(
        "l_text", "a", "n", "m", d.alias("d"), gap.alias("gap"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i")
    )
    shifts = F.sequence(F.ceil((F.col("gap") - F.col("d")) / 2).cast("int"), F.floor((F.col("gap") + F.col("d")) / 2).cast("int"))
    at = by_piece.withColumns(
        {
            "start": _piece_start(F.col("n"), F.col("m"), F.col("i")),
            "len": _piece_length(F.col("n"), F.col("m"), F.col("i")),
            "shift": F.explode(shifts),
        }
    )
    pos = F.col("start") + F.col("shift")
    inside = at.where((pos >= 0) & (pos + F.col("len") <= F.col("a")))
    return inside.select("l_text", F.xxhash64("n", "i", F.substring("l_text", pos + 1, F.col("len"))).alias("seg"))


def near_pairs(left: DataFrame, right: DataFrame, t: float) -> DataFrame:
    """``(l_text, r_text, score)`` of all pairs with similarity at least ``t``."""
    # probes are cut for lengths that occur; there are no more of them than letters in the longest text
    sizes = F.broadcast(right.select(F.length("r_text").alias("n")).distinct())
    met = left_segments(left, t, sizes).join(shuffled(right_segments(right, t)), "seg").select("l_text", "r_text").distinct()
    return met.withColumn("score", fuzzy.indel_ratio("l_text", "r_text")).where(F.col("score") >= t - SLACK)


# ------------------------------------------------------------------ block kernels

_SLOTS = 96


def _letter_counts(texts: list[str]) -> np.ndarray:
    """Counts per text over 96 letter slots; signs outside ASCII share one slot."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    slots = np.clip(codes - 32, 0, _SLOTS - 1)
    rows = np.repeat(np.arange(len(texts)), lengths)
    return np.bincount(rows * _SLOTS + slots, minlength=len(texts) * _SLOTS).reshape(len(texts), _SLOTS)


class _Texts:
    """A block of texts with lengths and letter counts."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.length = np.fromiter((len(t) for t in texts), dtype=np.float32, count=len(texts))
        self.counts = _letter_counts(texts)

    def words(self) -> None:
        """Add token facts: a repeated token or blank makes the token bounds loose."""
        self.tokens = [set(t.split()) for t in self.texts]
        self.loose = np.array([" ".join(dict.fromkeys(t.split())) != t for t in self.texts])
        self.forms = fuzzy.Tokens(self.texts)
        self.sorted = self.forms.sorted


def shared_letters(left: _Texts, right: _Texts) -> np.ndarray:
    """Size of the common letter multiset of every pair, an upper bound of its LCS.

    ``min(x, y)`` is the number of j with x >= j and y >= j, so one matrix
    product over such 0/1 columns gives all sums of minima.
    """
    a, b = left.counts, right.counts
    depth = np.minimum(a.max(axis=0), b.max(axis=0))
    slot = np.repeat(np.arange(_SLOTS), depth)
    level = np.concatenate([np.arange(1, d + 1) for d in depth]) if depth.any() else np.empty(0, dtype=np.int64)
    return (a[:, slot] >= level).astype(np.float32) @ (b[:, slot] >= level).astype(np.float32).T


class _Signed:
    """A block of texts in order of length, with letter counts and the bits of their bigrams."""

    def __init__(self, texts: list[str], is_query: bool):
        length = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.order = np.argsort(length, kind="stable")
        self.texts, self.length = [texts[i] for i in self.order.tolist()], length[self.order]
        self.counts = np.minimum(_letter_counts(self.texts), 255).astype(np.uint8)
        self.grams = _gram_bits(self.texts, self.length)
        if is_query:
            self.slots, self.levels = _telling_counts(self.counts)
            self.bits = self.signs(self.slots, self.levels)
        sizes, self.first = np.unique(self.length, return_index=True)
        self.runs = list(zip(sizes.tolist(), self.first.tolist(), [*self.first[1:].tolist(), len(texts)]))

    def signs(self, slots: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """One bit per text and chosen count: whether the text has the letter so many times."""
        return np.packbits(np.take(self.counts, slots, axis=1) >= levels, axis=1, bitorder="little").view(np.uint64).ravel()

    @property
    def nbytes(self) -> int:
        return self.counts.nbytes + self.grams.nbytes


#: Signs of a text that stand in one word, and words of bigram bits.
_SIGNS, _GRAM_WORDS = 64, 4
#: Pairs whose signs are compared at a time, and pairs held for the next bounds.
_TILE, _HELD = 1 << 16, 1 << 18


def _telling_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter slots with a count each, those that divide the texts most evenly, as many as a word has bits."""
    top = counts.max(axis=0, initial=0).astype(np.int64)
    slots, levels = np.repeat(np.arange(_SLOTS), top), np.concatenate([np.arange(1, n + 1) for n in top.tolist()] or [np.empty(0)])
    share = np.concatenate([(counts[:, s, None] >= np.arange(1, top[s] + 1)).mean(axis=0) for s in np.flatnonzero(top)] or [np.empty(0)])
    best = np.argsort(-share * (1 - share), kind="stable")[:_SIGNS]
    # a letter that no text has 255 times fills up the word
    fill = _SIGNS - len(best)
    return np.r_[slots[best], np.zeros(fill, np.int64)].astype(np.int64), np.r_[levels[best], np.full(fill, 256)].astype(np.int16)


def _gram_bits(texts: list[str], length: np.ndarray) -> np.ndarray:
    """Words whose bits are the hashed bigrams of each text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), length)
    inside = np.flatnonzero(row[1:] == row[:-1])
    mixed = (codes[inside] * np.uint64(0x9E3779B97F4A7C15) ^ codes[inside + 1] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
    flags = np.zeros((len(texts), 64 * _GRAM_WORDS), dtype=bool)
    flags[row[inside], (mixed % np.uint64(64 * _GRAM_WORDS)).astype(np.int64)] = True
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


def _missing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits of the rows of ``a`` that those of ``b`` lack."""
    return np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)


class IndelKernel(Kernel):
    """Best indel similarity; pairs below the threshold by their letters or bigrams are never scored.

    A similarity fixes how many letters either text may have outside the common subsequence.  Its
    letters beyond the other's are so many at most, which one word of signs per text tells for most
    pairs; its bigrams that the other lacks are bounded as in module ``grams``.
    """

    longer = (4, 8)

    def __init__(self, threshold: float):
        self.threshold = threshold

    def prepared_bytes(self, raw: float) -> float:
        return 300 + 6 * raw

    def prepare(self, block: pa.Table, is_query: bool) -> _Signed:
        return _Signed(block["text"].to_pylist(), is_query)

    def score(self, q: _Signed, c: _Signed, floor: np.ndarray):
        least = np.maximum(floor, self.threshold)[q.order]
        bits = c.signs(q.slots, q.levels)
        own, theirs = np.bitwise_count(q.bits).astype(np.int64), np.bitwise_count(bits).astype(np.int64)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for size, begin, end in c.runs:
            common = np.ceil(least * (q.length + size) / 200.0 - 1e-6).astype(np.int64)
            asked = np.flatnonzero(common <= np.minimum(q.length, size))
            mine, other, wide = q.bits[asked], bits[begin:end], end - begin
            # letters of either text that may stand outside the common subsequence
            x, y = (q.length - common)[asked], (size - common)[asked]
            need = np.maximum(own[asked] - x, 0).astype(np.uint8)
            step = max(1, _TILE // wide)
            word, count, met = np.empty((step, wide), np.uint64), np.empty((step, wide), np.uint8), np.empty(step * wide + 8, bool)
            near, held = [], 0
            for at in range(0, len(asked), step):
                n = min(step, len(asked) - at)
                np.bitwise_and(mine[at : at + n, None], other, out=word[:n])
                np.bitwise_count(word[:n], out=count[:n])
                np.greater_equal(count[:n], need[at : at + n, None], out=met[: n * wide].reshape(n, wide))
                places = true_places(met, n * wide)
                near.append((places + at * wide, count.ravel()[places]))
                held += len(places)
                if held > _HELD or at + step >= len(asked):
                    places, shared = (np.concatenate(v) for v in zip(*near))
                    i, j = np.divmod(places, wide)
                    keep = theirs[begin + j] - shared <= y[i]
                    i, j = i[keep], begin + j[keep]
                    found.append(self._scored(q, c, asked[i], j, x[i], y[i]))
                    near, held = [], 0
        return tuple(np.concatenate(v) for v in zip(*found))

    def _scored(self, q: _Signed, c: _Signed, qi: np.ndarray, ci: np.ndarray, x: np.ndarray, y: np.ndarray):
        """Scores of the pairs that miss no more bigrams of each other than ``x`` and ``y`` letters outside the subsequence explain."""
        keep = _missing(q.grams[qi], c.grams[ci]) <= 2 * x + y
        keep &= _missing(c.grams[ci], q.grams[qi]) <= x + 2 * y
        qi, ci = qi[keep], ci[keep]
        lcs = fuzzy.lcs_lengths([q.texts[i] for i in qi.tolist()], [c.texts[i] for i in ci.tolist()])
        size = (q.length[qi] + c.length[ci]).astype(np.float64)
        score = np.where(size == 0, 100.0, 200.0 * lcs / np.maximum(size, 1.0))
        keep = score >= self.threshold - SLACK
        return q.order[qi[keep]], c.order[ci[keep]], score[keep]


def _blend_bound(plain, sorted_, short, long, token_free):
    """Bound of the blended ratio from bounds of the common letters of both forms.

    ``plain`` and ``sorted_`` bound the LCS of the texts and of their sorted
    tokens; ``token_free`` marks pairs whose token forms these do not bound.
    """
    total = np.maximum(short + long, 1.0)
    ratio = 200.0 * plain / total
    close = np.maximum(ratio, np.where(token_free, 95.0, 190.0 * sorted_ / total))
    part = 200.0 * plain / np.maximum(short + plain, 1.0)
    token_part = np.where(token_free, 100.0, 200.0 * sorted_ / np.maximum(short + sorted_, 1.0))
    scale = np.where(long <= 8 * short, 0.9, 0.6)
    apart = np.maximum(ratio, scale * np.maximum(part, 0.95 * token_part))
    return np.where(long < 1.5 * short, close, apart) + 1e-3


def _token_free(q: _Texts, c: _Texts) -> np.ndarray:
    """Pairs that share a token, or where a repeated token or blank shortens the token forms."""
    free = q.loose[:, None] | c.loose[None, :]
    for token in set().union(*q.tokens) & set().union(*c.tokens):
        has_q = np.array([token in t for t in q.tokens])
        has_c = np.array([token in t for t in c.tokens])
        free[np.ix_(has_q, has_c)] = True
    return free


class WeightedKernel(Kernel):
    """Best blended ratio per query by branch and bound.

    Pairs are bounded by their shared letters, the survivors by their LCS, and
    what is left is scored in order of its bound, arrays of pairs at a time; a
    query stops once the next bound is below its best score, so the result is
    exact.
    """

    def __init__(self, threshold: float):
        self.threshold = threshold

    def prepared_bytes(self, raw: float) -> float:
        return 2000 + 20 * raw  # token sets and numbers are Python objects

    def prepare(self, block: pa.Table, is_query: bool) -> _Texts:
        ready = _Texts(block["text"].to_pylist())
        ready.words()
        return ready

    def score(self, q: _Texts, c: _Texts, floor: np.ndarray):
        none = np.empty(0, dtype=np.int64)
        start = np.maximum(floor, self.threshold)
        short = np.minimum(q.length[:, None], c.length[None, :])
        long = np.maximum(q.length[:, None], c.length[None, :])
        free = _token_free(q, c)
        letters = shared_letters(q, c)
        qi, ci = np.nonzero(_blend_bound(letters, letters, short, long, free) >= start[:, None])
        plain = fuzzy.lcs_pairs(q.texts, c.texts, qi, ci)
        ordered = fuzzy.lcs_pairs(q.sorted, c.sorted, qi, ci)
        bound = _blend_bound(plain, ordered, short[qi, ci], long[qi, ci], free[qi, ci])
        keep = bound >= start[qi]
        qi, ci, bound = qi[keep], ci[keep], bound[keep]
        order = np.lexsort((ci, -bound, qi))
        qi, ci, bound = qi[order], ci[order], bound[order]
        best, found, batch = start.astype(float), [(none, none, np.empty(0))], FIRST_BATCH
        while len(qi):  # the likeliest of every query, then more at a time of what can still win
            first = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]])
            now = np.arange(len(qi)) - np.repeat(first, np.diff(np.r_[first, len(qi)])) < batch
            score = fuzzy.weighted_pairs(q.forms, c.forms, qi[now], ci[now])
            good = score >= best[qi[now]]
            found.append((qi[now][good], ci[now][good], score[good]))
            np.maximum.at(best, qi[now], score)
            rest = ~now & (bound >= best[qi])
            qi, ci, bound, batch = qi[rest], ci[rest], bound[rest], 4 * batch
        return tuple(np.concatenate(x) for x in zip(*found))


def best_fuzzy(queries: DataFrame, names: DataFrame, threshold: float, kernel=WeightedKernel) -> DataFrame:
    """``(query_id, row_id, score)``: best name of every query, the lower ``row_id`` on ties.

    ``queries(query_id, text)``, ``names(row_id, text)``.  Both sides are sorted
    by length inside their partitions, so blocks hold texts of similar length.
    """
    q = queries.select("query_id", "text").where(F.col("text").isNotNull()).sortWithinPartitions(F.length("text"))
    n = names.select("row_id", "text").where(F.col("text").isNotNull()).sortWithinPartitions(F.length("text"))
    return top_matches(q, n, kernel(threshold), 1).drop("rank")


def near_best(queries: DataFrame, names: DataFrame) -> DataFrame:
    """:func:`best_fuzzy` of the queries with a name over ``NEAR`` similar, written.

    Under the blended ratio token forms weigh .95 and partial ones .9 at most, so a plain similarity
    over ``NEAR`` is the score itself, and no pair below it comes near.
    """
    asked = queries.select("query_id", F.col("text").alias("l_text")).where(F.col("text").isNotNull())
    known = names.where(F.col("text").isNotNull()).groupBy(F.col("text").alias("r_text")).agg(F.min("row_id").alias("row_id"))
    pairs = near_pairs(spread(asked.select("l_text").distinct(), "l_text"), spread(known.select("r_text"), "r_text"), NEAR)
    found = pairs.where(F.col("score") > NEAR + SLACK).join(shuffled(known), "r_text").join(shuffled(asked), "l_text")
    best = F.max_by(F.struct("row_id", "score"), F.struct(F.col("score"), -F.col("row_id")))
    return cut_lineage(found.groupBy("query_id").agg(best.alias("b")).select("query_id", "b.row_id", "b.score"))


def best_blended(queries: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """:func:`best_fuzzy` in two steps: near texts by their pieces, only what is open then by the block join."""
    near = near_best(queries, names)
    rest = queries.join(shuffled(near), "query_id", "left_anti")
    return near.unionByName(best_fuzzy(rest, names, threshold))


def best_indel(queries: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """:func:`best_fuzzy` under plain indel similarity, by the cheaper of two exact ways.

    The bigram index pays where bigrams tell texts apart; its matches per pair are measured
    first on a few texts of both sides.  Texts of few letters, all alike, go through the block
    join, which needs less work per pair.
    """
    if threshold >= LEAST_THRESHOLD and matches_per_pair(queries, names, threshold) * MATCH_COST <= 1.0:
        return GramIndex(queries, names, threshold).best()
    return best_fuzzy(queries, names, threshold, IndelKernel)


# -------------------------------------------------------------- best sorted match


def best_sorted_matches(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """``(l_key, r_key, score)``: best right key of every left key that reaches ``threshold``.

    ``left(l_key)``; ``right(r_key, ord)`` with the ordinal that settles ties.
    """
    l_texts = spread(left.select("l_key", sorted_tokens(F.col("l_key")).alias("l_text")), "l_text")
    r_texts = (
        spread(right.select("r_key", "ord", sorted_tokens(F.col("r_key")).alias("r_text")), "r_text")
        .groupBy("r_text")
        .agg(F.min_by("r_key", "ord").alias("r_key"), F.min("ord").alias("ord"))
    )
    open_texts = l_texts.select("l_text").distinct()
    same = open_texts.join(shuffled(r_texts), F.col("l_text") == F.col("r_text")).select(
        "l_text", "r_key", F.lit(100.0).alias("score")
    )
    unequal = open_texts.join(shuffled(r_texts.select(F.col("r_text").alias("l_text"))), "l_text", "left_anti")
    near = max(threshold, NEAR)
    best = F.max_by(F.struct("r_key", "score"), F.struct(F.col("score"), -F.col("ord")))
    close = (
        near_pairs(unequal, r_texts.select("r_text"), near)
        .join(shuffled(r_texts), "r_text")
        .groupBy("l_text")
        .agg(best.alias("b"))
        .select("l_text", "b.r_key", "b.score")
    )
    found = cut_lineage(same.unionByName(close))
    if threshold < near:
        rest = numbered(open_texts.join(shuffled(found), "l_text", "left_anti").select(F.col("l_text").alias("text")), "query_id")
        names = r_texts.select(F.col("ord").alias("row_id"), F.col("r_text").alias("text"), "r_key")
        far = best_indel(rest, names, threshold)
        far = far.join(shuffled(names.select("row_id", "r_key")), "row_id").join(shuffled(rest.withColumnRenamed("text", "l_text")), "query_id")
        found = found.unionByName(far.select("l_text", "r_key", "score"))
    return l_texts.join(shuffled(found), "l_text").select("l_key", "r_key", "score")


# ----------------------------------------------------------------------- the join


def _text_or_nan(df: DataFrame, names: list[str]) -> Column:
    present = present_columns(df, names)
    return F.coalesce(F.col(present[0]).cast("string"), F.lit("nan")) if present else F.lit("")


NAME_COLUMNS = ["player", "name"]
LEFT_CLUBS = ["squad", "club", "team"]
RIGHT_CLUBS = ["squad", "club", "team", "league_tm"]


def _keyed(df: DataFrame, clubs: list[str]) -> DataFrame:
    folded = df.withColumn("name_key", fold_name(_text_or_nan(df, NAME_COLUMNS)))
    return folded.withColumn("full_key", match_key(F.col("name_key"), fold_name(_text_or_nan(df, clubs))))


def _right_keys(right: DataFrame, key: str) -> DataFrame:
    """One row per key: the last row carries the data, the first gives the order."""
    return right.groupBy(F.col(key).alias("r_key")).agg(F.min("row_id").alias("ord"), F.max("row_id").alias("right_row_id"))


def _pass(left: DataFrame, right: DataFrame, key: str, threshold: float, strategy: str) -> DataFrame:
    keys = _right_keys(right, key)
    matched = best_sorted_matches(left.select(F.col(key).alias("l_key")).distinct(), keys.select("r_key", "ord"), threshold)
    matched = matched.join(shuffled(keys.select("r_key", "right_row_id")), "r_key")
    return (
        left.select("row_id", F.col(key).alias("l_key"))
        .join(shuffled(matched), "l_key")
        .select("row_id", "right_row_id", F.col("score").alias("match_score"), F.lit(strategy).alias("match_strategy"))
    )


def fuzzy_links(left: DataFrame, right: DataFrame, threshold: float = 85.0) -> DataFrame:
    """``(row_id, right_row_id, match_score, match_strategy)`` of linked left rows.

    Name and club together first; rows left over by name alone, with a
    stricter threshold.
    """
    keyed_left, keyed_right = _keyed(left, LEFT_CLUBS), _keyed(right, RIGHT_CLUBS)
    full = cut_lineage(_pass(keyed_left, keyed_right, "full_key", threshold, "full_key"))
    rest = keyed_left.join(shuffled(full.select("row_id")), "row_id", "left_anti")
    return full.unionByName(_pass(rest, keyed_right, "name_key", max(threshold + 5.0, 90.0), "name_only"))


def fuzzy_join(left: DataFrame, right: DataFrame, threshold: float = 85.0, metadata: list[str] = VALUE_METADATA) -> DataFrame:
    """Left rows with right metadata, score and strategy; unlinked rows are kept.

    ``out_order`` lists linked rows first, each part in row order.
    """
    links = fuzzy_links(left, right, threshold)
    brought = right.select(F.col("row_id").alias("right_row_id"), *present_columns(right, metadata))
    out = left.join(shuffled(links), "row_id", "left").join(shuffled(brought), "right_row_id", "left").drop("right_row_id")
    out = out.withColumn("match_strategy", F.coalesce("match_strategy", F.lit("no_match")))
    return out.withColumn("out_order", F.struct((F.col("match_strategy") == "no_match").alias("unlinked"), "row_id"))


# ---------------------------------------------------------------- name resolution

#: First letters under which queries and places in names are brought together.
HEAD = 3


def name_dimension(profiles: DataFrame) -> DataFrame:
    """Lower-cased names: first row gives the order, last row the answer."""
    return profiles.where(F.col("player").isNotNull()).groupBy(F.lower("player").alias("name")).agg(
        F.min("row_id").alias("ord"), F.max("row_id").alias("row_id"), F.max_by("player", "row_id").alias("player")
    )


def containing_names(queries: DataFrame, names: DataFrame) -> DataFrame:
    """``(query_id, ord, hits)``: first name that contains the query text, and how many do.

    Every place of a name begins a suffix.  A suffix is cut to the lengths of the query texts that
    begin with its first ``HEAD`` letters, and the cuts are counted by their letters, each name once,
    before any query sees them: a text then meets one row, its own, however many names hold it.
    Equal query texts are answered once; an empty text has no row.
    """
    asked = cut_lineage(queries.where(F.length("text") > 0).select("query_id", "text"))
    # texts shorter than a head are heads of their own size
    heads = asked.groupBy(F.substring("text", 1, HEAD).alias("head")).agg(F.collect_set(F.length("text")).alias("lengths"))
    size, name = F.length("name"), F.col("name")
    spaced = spread(names.select("ord", "name"), "ord").where(size > 0)
    places = spaced.select("ord", "name", F.explode(F.sequence(F.lit(1), size)).alias("at"))
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(HEAD), size - F.col("at") + 1)))
    begun = places.select("ord", "name", "at", sizes.alias("k")).withColumn("head", F.substring(name, F.col("at"), F.col("k")))
    cuts = begun.join(heads, "head").select("ord", "name", "at", F.explode("lengths").alias("n")).where(F.col("at") + F.col("n") - 1 <= size)
    cuts = cuts.withColumn("text", F.substring(name, F.col("at"), F.col("n"))).where(F.position("text", "name") == F.col("at"))
    found = cuts.groupBy("text").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("hits"))
    return asked.join(shuffled(found), "text").select("query_id", "ord", "hits")


def resolve_names(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(query_id, query, stage, row_id, score, candidates)`` of ``requests(query_id, query)``.

    Exact, then contained, then blended ratio against last names (at least
    60), then against full names (at least 55); else ``not_found``.
    """
    names = name_dimension(profiles)
    asked = requests.select("query_id", "query", F.lower(F.trim("query")).alias("text"))
    exact = asked.join(shuffled(names.select(F.col("name").alias("text"), "row_id")), "text").select(
        "query_id", F.lit("exact").alias("stage"), "row_id", F.lit(100.0).alias("score"), F.lit(1).cast("long").alias("candidates")
    )
    open_1 = asked.join(shuffled(exact), "query_id", "left_anti")
    # An empty text is contained in every name: one aggregate row answers it.
    all_names = names.agg(F.min_by("row_id", "ord").alias("row_id"), F.count(F.lit(1)).alias("candidates"))
    blank = open_1.where(F.col("text") == "").join(F.broadcast(all_names.withColumn("text", F.lit(""))), "text").select(
        "query_id", F.lit("contained").alias("stage"), "row_id", F.lit(None).cast("double").alias("score"), "candidates"
    )
    inside = containing_names(open_1, names).join(shuffled(names.select("ord", "row_id")), "ord").select(
        "query_id", F.lit("contained").alias("stage"), "row_id", F.lit(None).cast("double").alias("score"), F.col("hits").alias("candidates")
    )
    settled = cut_lineage(exact.unionByName(inside).unionByName(blank))
    open_2 = asked.join(shuffled(settled), "query_id", "left_anti")
    by_last = fuzzy_last_names(open_2, names, 60.0, "fuzzy_last_name")
    open_3 = open_2.join(shuffled(by_last), "query_id", "left_anti")
    by_full = best_blended(open_3, names.select(F.col("ord").alias("row_id"), F.col("name").alias("text")), 55.0)
    by_full = by_full.withColumnRenamed("row_id", "ord").join(shuffled(names.select("ord", "row_id")), "ord").select(
        "query_id", F.lit("fuzzy_full_name").alias("stage"), "row_id", "score", F.lit(1).cast("long").alias("candidates")
    )
    found = reduce(DataFrame.unionByName, [settled, by_last, by_full])
    return requests.select("query_id", "query").join(shuffled(found), "query_id", "left").withColumn(
        "stage", F.coalesce("stage", F.lit("not_found"))
    )


def last_name_dimension(names: DataFrame) -> DataFrame:
    """Last tokens of several-word names: the first row gives the order, the name seen last the answer."""
    last = F.element_at(F.split("name", r"\s+"), -1)
    return names.where(F.contains("name", F.lit(" "))).groupBy(last.alias("last")).agg(
        F.min("ord").alias("last_ord"), F.max("row_id").alias("row_id"), F.max_by("name", "row_id").alias("name")
    )


def fuzzy_last_names(queries: DataFrame, names: DataFrame, threshold: float, stage: str) -> DataFrame:
    last = last_name_dimension(names)
    found = best_blended(queries, last.select(F.col("last_ord").alias("row_id"), F.col("last").alias("text")), threshold)
    joined = found.withColumnRenamed("row_id", "last_ord").join(shuffled(last.select("last_ord", "row_id")), "last_ord")
    joined = joined.select("query_id", F.lit(stage).alias("stage"), "row_id", "score", F.lit(1).cast("long").alias("candidates"))
    return cut_lineage(joined)


def lookup_profiles(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """First row with the name (any case), else the first row containing it, else ``not_found``."""
    names = profiles.where(F.col("player").isNotNull()).groupBy(F.lower("player").alias("name")).agg(F.min("row_id").alias("ord"))
    asked = requests.select("query_id", F.lower("query").alias("text"))
    exact = asked.join(shuffled(names.withColumnRenamed("name", "text")), "text").select("query_id", F.lit("exact").alias("status"), F.col("ord").alias("row_id"))
    inside = containing_names(asked.join(shuffled(exact), "query_id", "left_anti"), names).select(
        "query_id", F.lit("contained").alias("status"), F.col("ord").alias("row_id")
    )
    found = requests.join(shuffled(exact.unionByName(inside)), "query_id", "left")
    return found.withColumn("status", F.coalesce("status", F.lit("not_found")))


# ------------------------------------------------------------ benchmark alignment


def align_benchmark(curated: DataFrame, profiles: DataFrame, threshold: float = 80.0) -> DataFrame:
    """Curated name pairs mapped to profile names; unmatched and self pairs drop out.

    ``curated(query, similar, ord)``; ranks are renumbered per curated query.
    """
    names = profiles.where(F.col("player").isNotNull()).groupBy("player").agg(F.min("row_id").alias("row_id"))
    wanted = curated.select(F.col("query").alias("raw")).union(curated.select(F.col("similar").alias("raw"))).distinct()
    wanted = numbered(wanted.select("raw", F.lower("raw").alias("text")), "query_id")
    found = best_blended(wanted, names.select("row_id", F.lower("player").alias("text")), threshold)
    mapped = cut_lineage(wanted.join(shuffled(found), "query_id").join(shuffled(names), "row_id").select("raw", "player"))
    both = curated.join(shuffled(mapped.toDF("query", "query_player")), "query").join(shuffled(mapped.toDF("similar", "similar_player")), "similar")
    kept = both.where(F.col("query_player") != F.col("similar_player"))
    return rank_within(kept, "query", F.asc("ord")).select("query", "query_player", "similar_player", F.col("rank").alias("tm_rank"))


# ---------------------------------------------------------------- entity candidates

GOOD_ENOUGH, ACCEPTED, CANDIDATES_READ = 0.65, 0.45, 6


def link_candidates(searches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best candidate of every search, or none below the accepted score.

    ``searches(row_id, plain)``; ``candidates(row_id, variant_no, cand_no,
    candidate_plain, url)``.  Variants are read in order up to the first one
    with a good enough candidate; a later candidate must be strictly better.
    """
    usable = candidates.where((F.col("cand_no") <= CANDIDATES_READ) & F.startswith("url", F.lit("http")))
    scored = usable.join(shuffled(searches), "row_id").withColumn("score", token_name_score(F.col("plain"), F.col("candidate_plain")))
    reached = F.col("score") >= GOOD_ENOUGH
    order = F.struct(
        reached.alias("reached"), F.when(reached, -F.col("variant_no")).otherwise(0).alias("first_variant"),
        F.col("score"), -F.col("variant_no"), -F.col("cand_no"),
    )
    best = scored.where(F.col("score") > 0).groupBy("row_id").agg(
        F.max_by(F.struct("candidate_plain", "url", "score", "variant_no"), order).alias("best")
    )
    kept = best.select("row_id", "best.*").where(F.col("score") >= ACCEPTED)
    return searches.join(shuffled(kept), "row_id", "left")
