"""Exact substring dedup: every byte under a string of ``LENGTH`` bytes that starts elsewhere too goes.

Which strings can be equal is found by anchors.  A string's anchor is the place of the
smallest hash among its ``GRAM``-byte pieces, so equal strings have equal anchors at equal
places.  Anchors of all documents are counted by hash; strings whose anchor hash occurs once
are done.  The strings of one anchor stand next to each other and make up its *token*
(``LENGTH`` bytes and a few more); a token met twice or more is repeated as a whole (two 64-bit
hashes of it agree, over the anchor's gram and over the whole).

Tokens met once under an anchor that has others, which lie at the edges of what is repeated, are
sorted with one representative of each of those others: their suffixes are compared by prefix
polynomial hashes and bisection for the common extension, merged bottom-up, and each pair of
neighbours with an extension of ``LENGTH`` or more is verified byte by byte.

Spark does the counting, joins and grouping; tasks see documents one by one, or the tokens of
some anchors.  Copies add to counts only, so a group holds different tokens; an anchor with more
than ``HOT_TOKENS`` different ones is dealt string by string instead.

Defined cases: a NULL text counts as empty; texts under ``LENGTH`` bytes keep every byte;
rows of equal doc_id and repeated rows are separate texts, so repeated rows of ``LENGTH``
bytes and more go entirely; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.expressions import only
from kindred.session import cut_lineage, task_count

LENGTH = 200
GRAM = 100
HOT_TOKENS = 1 << 16
#: Bytes of texts hashed at once, tokens a task dedups before passing on, tokens it sorts together.
CHUNK, PASS_ON, TOGETHER = 1 << 18, 50_000, 20_000
NO_ID = -(1 << 63)
#: Low bits of a mark: how its token is sorted (0: it is repeated as a whole), and whether it only represents its copies.
EDGE, HOT, HOW, SHOWN = 1, 2, 3, 4
FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so they have inverses modulo 2^64
#: Bits of a ranked gram that hold its place in a chunk.
PLACE = np.uint64((1 << 21) - 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse, up to ``n``."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, 1 << 16) * 2
        made = []
        for base in (FACTORS[which], pow(FACTORS[which], -1, 1 << 64)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _POWERS[which] = tuple(made)
    powers, inverses = _POWERS[which]
    return powers[:n], inverses[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class PrefixHashes:
    """Prefix polynomial hashes of bytes: the hash of any piece in constant time."""

    def __init__(self, values: np.ndarray, which: int):
        """``values`` are the bytes' table entries, which both hashes share."""
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        powers, self.inverses = _powers(which, len(values) + 1)
        np.cumsum(values * powers[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.inverses[start])

    def of_all(self, length: int) -> np.ndarray:
        """Hashes of all pieces of one length."""
        return _mixed((self.sums[length:] - self.sums[:-length]) * self.inverses[: len(self.sums) - length])


def _least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours, by minima from both ends of blocks."""
    n = -(-len(h) // width)
    blocks = np.full(n * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[: len(h)] = h
    blocks = blocks.reshape(n, width)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(back[: len(h) - width + 1], ahead[width - 1 : len(h)])


def _runs(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(x for _, _, x in pieces), dtype=np.uint8)
    sizes = np.array([len(x) for _, _, x in pieces])
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
    values = _BYTES[data]
    grams = PrefixHashes(values, 0).of_all(GRAM)
    ranked = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least_in_windows(ranked, LENGTH - GRAM + 1) & PLACE).astype(np.int64)
    first, last = piece[: len(anchor)], piece[LENGTH - 1 :]
    whole = first == last
    change = (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1]) | (whole[1:] != whole[:-1])
    start = np.concatenate([[0], np.flatnonzero(change) + 1])
    stop = np.append(start[1:], len(anchor)) - 1
    start, stop = start[whole[start]], stop[whole[start]]
    token = PrefixHashes(values, 1).of(start, stop - start + LENGTH)
    at, off = piece[start], anchor[start] - start
    owner, shift = np.array([x for x, _, _ in pieces])[at], np.array([x for _, x, _ in pieces])[at] - (np.cumsum(sizes) - sizes)[at]
    return owner, grams[anchor[start]], start + shift, stop + shift, token, off


def anchor_runs(texts: list[bytes]):
    """Blocks of runs of strings of one anchor: number of the text, anchor hash, first and last
    start, token hash, and the anchor's distance from the first start.

    The anchor of a string is the leftmost of its smallest grams by the upper bits of their
    hash.  Short texts are hashed together, long ones in overlapping pieces.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        if len(text) > CHUNK:
            for at in range(0, len(text) - LENGTH + 1, CHUNK):
                yield _runs([(i, at, text[at : at + CHUNK + LENGTH - 1])])
            continue
        held.append((i, 0, text))
        size += len(text)
        if size >= CHUNK:
            yield _runs(held)
            held, size = [], 0
    if held:
        yield _runs(held)


# -- suffix sort of tokens -------------------------------------------------------------------


class SuffixSorter:
    """Suffixes of concatenated tokens, ordered within segments by hash-compared merging."""

    def __init__(self, data: np.ndarray):
        self.data, self.hashes = data, PrefixHashes(_BYTES[data], 1)

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes ``a`` and ``b``, up to ``most``, by bisection."""
        low, high = np.zeros(len(a), dtype=np.int64), most.astype(np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashes.of(a, mid) == self.hashes.of(b, mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def _before(self, a, b, segment, start, length) -> np.ndarray:
        """Whether suffix number ``a`` sorts before ``b``: segment, then bytes, then length."""
        most = np.minimum(length[a], length[b])
        apart = segment[a] != segment[b]
        common = self.extension(start[a], start[b], np.where(apart, 0, most))
        ended = common == most
        last = len(self.data) - 1
        byte = self.data[np.minimum(start[a] + common, last)] < self.data[np.minimum(start[b] + common, last)]
        return np.where(apart, segment[a] < segment[b], np.where(ended, length[a] < length[b], byte))

    def sort(self, segment: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Order of the suffixes by bottom-up mergesort; all merges of one width run together."""
        n, width = len(start), 1
        order = np.arange(n)
        while width < n:
            place = np.arange(n)
            block = place // width
            own, other = place % width, (block ^ 1) * width  # rank in the own run, begin of the other
            low, high = np.minimum(other, n), np.minimum(other + width, n)
            first = low.copy()
            right = (block & 1).astype(bool)
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                mine, theirs = order[open_], order[mid]
                ahead = self._before(theirs, mine, segment, start, length)
                tied = right[open_] & ~ahead & ~self._before(mine, theirs, segment, start, length)
                up = ahead | tied  # of equal ones the left run's come first
                low[open_[up]] = mid[up] + 1
                high[open_[~up]] = mid[~up]
            merged = np.empty(n, dtype=np.int64)
            merged[(block // 2) * 2 * width + own + (low - first)] = order
            order, width = merged, width * 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray, common: np.ndarray) -> np.ndarray:
        """``common`` where the bytes agree, else the extension that they really have."""
        out = common.copy()
        for k in range(0, len(a), 4096):
            x, y, c = a[k : k + 4096], b[k : k + 4096], common[k : k + 4096]
            steps = np.arange(int(c.max(initial=0)))
            inside = steps[None, :] < c[:, None]
            last = len(self.data) - 1
            differ = inside & (self.data[np.minimum(x[:, None] + steps, last)] != self.data[np.minimum(y[:, None] + steps, last)])
            bad = differ.any(axis=1)
            out[k : k + 4096][bad] = differ[bad].argmax(axis=1)
        return out


def repeated_strings(groups: np.ndarray, tokens: list[bytes], offsets: np.ndarray) -> list[np.ndarray]:
    """Per token a mask of its starts whose string also stands in another token of its group.

    ``offsets`` is the anchor's place in the token: strings are compared at equal distance from
    their anchors.  Starts whose hash no other token shares are left out, and of the others only
    where runs begin are sorted; an extension settles the starts that it spans.
    """
    sizes = np.array([len(t) for t in tokens])
    bases = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    sorter = SuffixSorter(np.frombuffer(b"".join(tokens), dtype=np.uint8))
    owner = np.repeat(np.arange(len(tokens)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, shift = bases[owner] + inside, inside - offsets[owner]
    segments = groups[owner].astype(np.int64) * (4 * LENGTH) + shift  # shifts lie between minus and plus LENGTH
    alike = _mixed(sorter.hashes.of(at, LENGTH) ^ (segments.astype(np.uint64) * np.uint64(FACTORS[0])))
    order = np.argsort(alike)
    same = alike[order[1:]] == alike[order[:-1]]
    open_, done = np.zeros(len(owner), dtype=bool), np.zeros(len(owner), dtype=bool)
    open_[order[1:][same]] = open_[order[:-1][same]] = True
    candidates = open_.copy()
    while open_.any():
        begins = np.flatnonzero(open_ & ~np.concatenate([[False], open_[:-1] & (owner[1:] == owner[:-1])]))
        rows = np.flatnonzero(candidates & np.isin(segments, segments[begins]))
        length = bases[owner[rows]] + sizes[owner[rows]] - at[rows]
        order = sorter.sort(segments[rows], at[rows], length)
        a, b = rows[order[:-1]], rows[order[1:]]
        near = segments[a] == segments[b]
        a, b = a[near], b[near]
        most = np.minimum(length[order[:-1]], length[order[1:]])[near]
        common = sorter.verified(at[a], at[b], sorter.extension(at[a], at[b], most))
        for one in (a, b):
            hit = common >= LENGTH
            span = common[hit] - LENGTH + 1
            reach = np.repeat(one[hit], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
            done[reach] = True
        open_ &= ~done
        open_[rows] = False  # settled either way
    ends = np.cumsum(counts)
    return [done[e - c : e] for e, c in zip(ends, counts)]


# -- Spark -----------------------------------------------------------------------------------


def _bytes(value) -> bytes:
    return (value.as_py() or "").encode("utf-8", "surrogatepass")


def _anchors(docs: DataFrame, placed: bool) -> DataFrame:
    """``(a, t)`` of every anchor, or ``(a, t, _id, _h, m)`` with its run in its document.

    ``m`` packs a run's first start, its length less one and the anchor's distance.
    """
    schema = "a long, t long, _id long, _h long, m long" if placed else "a long, t long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            texts = [_bytes(x) for x in batch.column(0)]
            for owner, anchor, start, stop, token, off in anchor_runs(texts):
                columns = [pa.array(anchor.view(np.int64)), pa.array(token.view(np.int64))]
                if placed:
                    own = pa.array(owner)
                    columns += [batch.column(1).take(own), batch.column(2).take(own), pa.array(start << 19 | (stop - start) << 11 | off << 3)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("text", "_id", "_h").mapInArrow(run, schema)


def _run_of(mark: int) -> tuple[int, int]:
    """First and last start of a packed run."""
    start = mark >> 19
    return start, start + (mark >> 11 & 255)


def _tokens_of(data: bytes, marks: list[dict]):
    """Group, hash, anchor distance, bytes and first start of the tokens to sort (``EDGE``), or
    of their single strings where the anchor is hot (``HOT``)."""
    digest = xxhash.xxh3_64_intdigest
    for mark in marks:
        (s, e), kind = _run_of(mark["m"]), mark["m"] & HOW
        if kind == EDGE:
            token = data[s : e + LENGTH]
            yield mark["a"], digest(token) - (1 << 63), mark["m"] >> 3 & 255, token, s
        elif kind == HOT:
            for p in range(s, e + 1):
                token = data[p : p + LENGTH]
                yield digest(token, 1) - (1 << 63), digest(token) - (1 << 63), 0, token, p


def _edge_tokens(listed: DataFrame, references: bool) -> DataFrame:
    """Tokens of the marks to sort.

    Without ``references``: group, token hash, anchor distance, bytes, number of places, summed
    up within a task.  With them: group, token hash and the place ``(_id, _h, s)``, but for the
    representatives, whose places are settled.
    """
    schema = "g long, t long, _id long, _h long, s long" if references else "g long, t long, off int, bytes binary, n long"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()) if references else (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
    names = [x.split()[0] for x in schema.split(", ")]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            places: list[tuple] = []
            for i, marks in enumerate(batch.column(3).to_pylist()):
                marks = [m for m in marks or () if m["m"] & HOW and not (references and m["m"] & SHOWN)]
                if not marks:
                    continue
                for g, t, off, data, s in _tokens_of(_bytes(batch.column(0)[i]), marks):
                    if references:
                        places.append((g, t, batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), s))
                    else:
                        held.setdefault((g, t), [off, data, 0])[2] += 1
                if len(held) >= PASS_ON:
                    yield out([(*k, *x) for k, x in held.items()])
                    held = {}
                if len(places) >= PASS_ON:
                    yield out(places)
                    places = []
            if places:
                yield out(places)
        if held:
            yield out([(*k, *x) for k, x in held.items()])

    # doc_id is not read here; with it the texts' exchange is the one that the results use
    return listed.select("text", "_id", "_h", "marks", "doc_id").mapInArrow(run, schema)


def _ranges(mask: np.ndarray) -> list[int]:
    """First and last place of every run of a mask, one after the other."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [int(x) - k % 2 for k, x in enumerate(edge)]


def _settled(tokens: DataFrame) -> DataFrame:
    """``(g, t, ranges)``: starts of each token, in pairs first and last, whose string is repeated."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        merged: dict[tuple, int] = {}
        for g, t, off, data, n in rows:
            merged[g, t, off, data] = merged.get((g, t, off, data), 0) + n
        keys = sorted(merged)
        groups = np.unique([k[0] for k in keys], return_inverse=True)[1]
        several = np.bincount(groups)[groups] > 1
        masks: list[np.ndarray] = [np.full(len(k[3]) - LENGTH + 1, merged[k] > 1) for k in keys]
        if several.any():
            some = np.flatnonzero(several)
            found = repeated_strings(groups[some], [keys[i][3] for i in some], np.array([keys[i][2] for i in some]))
            for i, mask in zip(some, found):
                masks[i] = masks[i] | mask
        return pa.RecordBatch.from_pydict({
            "g": pa.array([k[0] for k in keys], pa.int64()), "t": pa.array([k[1] for k in keys], pa.int64()),
            "ranges": pa.array([_ranges(m) for m in masks], pa.list_(pa.int32())),
        })

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns)):
                if len(rows) >= TOGETHER and row[0] != rows[-1][0]:
                    yield settle(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield settle(rows)

    by_group = tokens.repartition(task_count(tokens.sparkSession), "g").sortWithinPartitions("g")
    return by_group.mapInArrow(run, "g long, t long, ranges array<int>")


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def _results(joined: DataFrame, doc_id: str) -> DataFrame:
    """Digest of every document from its whole runs (marks without a kind) and its settled ranges."""
    schema = f"doc_id long, {RESULT}"

    def run(batches):
        for batch in batches:
            rows = []
            for doc, value, marks, edges in zip(*(batch.column(i) for i in range(4))):
                data, marks, edges = _bytes(value), marks.as_py() or (), edges.as_py() or ()
                pairs = [_run_of(m["m"]) for m in marks if not m["m"] & HOW]
                pairs += [(e["s"] + a, e["s"] + b) for e in edges for a, b in zip(e["ranges"][::2], e["ranges"][1::2])]
                gone = np.zeros(len(data) + 1, dtype=np.int32)
                if pairs:
                    at = np.array(pairs)
                    np.add.at(gone, at[:, 0], 1)
                    np.add.at(gone, at[:, 1] + LENGTH, -1)
                mask = np.cumsum(gone[:-1]) > 0
                spans = _ranges(mask)
                kept = np.frombuffer(data, dtype=np.uint8)[~mask].tobytes()
                rows.append((doc.as_py(), len(data), len(data) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), spans))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)], names=names)

    return joined.select(doc_id, "text", "marks", "edges").mapInArrow(run, schema)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the removed ``spans``.

    ``spans`` holds the first and last byte of every removed run, one after the other.
    """
    rows = only(docs, "doc_id", "text").withColumns({"_id": F.coalesce("doc_id", F.lit(NO_ID)), "_h": F.xxhash64("text")})
    # sets: rows of one id and text hold the same marks
    marks = _marks(rows).groupBy("_id", "_h").agg(F.collect_set(F.struct("m", "a")).alias("marks"))
    listed = rows.join(marks, ["_id", "_h"], "left")  # the same plan three times, so texts are shuffled once
    settled = _settled(_edge_tokens(listed, references=False)).where(F.size("ranges") > 0)
    places = _edge_tokens(listed, references=True)
    edges = places.join(settled, ["g", "t"]).groupBy("_id", "_h").agg(F.collect_list(F.struct("s", "ranges")).alias("edges"))
    return _results(listed.join(edges, ["_id", "_h"], "left"), "doc_id")


def _marks(rows: DataFrame) -> DataFrame:
    """``(_id, _h, m, a)``: runs repeated as a whole, and those to sort with their anchor.

    Tables are written where Spark is to split hot anchors or tokens in the next join.
    """
    counted = _anchors(rows, placed=False).groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    repeated = cut_lineage(counted.where("n > 1").select("a", (F.col("low") != F.col("high")).alias("mixed")))
    hits = cut_lineage(_anchors(rows, placed=True).join(repeated, "a"))
    mixed = hits.where("mixed")
    # one place of each token: of a token met once its only one, else any, all of one row
    tokens = cut_lineage(mixed.groupBy("a", "t").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("_id", "_h", "m")]))
    crowded = tokens.groupBy("a").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > HOT_TOKENS)
    kind = F.when(F.col("k").isNull(), EDGE).otherwise(HOT) + F.when(F.col("n") > 1, SHOWN).otherwise(0)
    sorted_ = tokens.join(crowded, "a", "left").select("_id", "_h", (F.col("m") + kind).alias("m"), "a")
    whole = hits.where("not mixed").unionByName(mixed.join(tokens.where("n > 1").select("a", "t"), ["a", "t"]))
    return whole.select("_id", "_h", "m", F.lit(None).cast("long").alias("a")).unionByName(sorted_)
