"""Alignment of two tokenizers' tokens: common ends cut both id lists into groups.

For a text, the cumulative byte ends of either tokenizer's tokens are keys of a
dictionary to token indices; the sorted common keys of both dictionaries slice the two id
lists, and every slice links all its tokens of one side with all of the other.  Tokens of both
vocabularies never reach across the start of a run of white space (checked when a vocabulary
is loaded: signs that break this do not cut), so texts are cut there, the distinct pieces of many
documents are joined and aligned once, and a document is the concatenation of its pieces.

Counts of linked id pairs need all documents: a chunk of documents (about ``CHUNK_CHARS``) lists
each of its pairs once, with the number of its documents that hold it.  So the commonest pair
has one row per chunk, never one per document, and no key is hot.  Counts go back to chunks in
the same form, where sums per document are taken over the aligned pieces.

Defined cases: a text that is NULL, empty, or not spelled by the tokens of either side has no
tokens, and a NULL text counts like an empty one; texts of any length are aligned whole (a
chunk holds at least one); equal rows count as documents each; a NULL doc_id is kept; an empty
table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import io
import os
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.expressions import only
from kindred.llm.pieces import SPACE, by_ranks, byte_names, give_back, latin
from kindred.session import cut_lineage, task_count

#: Characters of a chunk, and those encoded by one call.
CHUNK_CHARS, CALL_CHARS = 4_000_000, 150_000
#: Pieces of the documents whose links are listed together.
SLICE_PIECES = 100_000
#: Links from which a group's are counted by distinct ids.
LARGE_GROUP = 4096
RESULTS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_MADE: dict[tuple[str, str], Aligner] = {}


class Aligner:
    """Aligned pieces of texts under a byte-level vocabulary (A) and a piece vocabulary (B)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        a_bytes, self.quick = byte_names(path_a), by_ranks(path_a)
        names = [self.b.id_to_piece(i) for i in range(len(self.b))]
        b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.bytes = (a_bytes, b_bytes)
        self.sizes = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes)
        #: Ids as text with what follows: A's "," and "|", then B's ",", ";" and the end of a piece.
        self.printed = [f"{i}{sign}" for side, signs in zip(self.bytes, (",|", ",;\n")) for sign in signs for i in range(len(side))]
        self.kinds = np.cumsum([0, *[len(side) for side, n in zip(self.bytes, (2, 3)) for _ in range(n)]])
        spelled = [x.decode("utf-8", "ignore") for x in a_bytes] + [n.replace("▁", " ") for n in names]
        inner = re.compile(f"[^{SPACE}]([{SPACE}])").findall
        crossing = "".join(sorted({c for name in spelled for c in inner(name)}))
        more = f"(?:[{re.escape(crossing)}][{SPACE}]*[^{SPACE}]*)*" if crossing else ""
        self.cut = re.compile(f"[{SPACE}]*[^{SPACE}]+{more}|[{SPACE}]+").findall
        self.ends_blank = re.compile(f"[{SPACE}]\\Z").search

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that begins with white space, as both encode it inside a longer one; None where they do not spell it."""
        lead = "" if text[0] == " " and len(text) > 1 else " x"  # B puts a space before a text, and has none for an empty one
        a, b = self._a_ids(lead + text), self.b.encode((lead + text)[1:])
        if lead:
            a, b = a[len(self._a_ids(lead)) :], b[len(self.b.encode(lead[1:])) :]
        spelled = text.encode()
        for ids, names in zip((a, b), self.bytes):
            if b"".join(map(names.__getitem__, ids)) != spelled:
                return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _a_ids(self, text: str) -> list[int]:
        if self.quick and latin(text):
            return self.quick.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _runs(self, pieces: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Runs of pieces that are spelled, with the ids of each run; others are left out."""
        ids = self._ids("".join(pieces))
        if ids:
            yield pieces, *ids
        elif len(pieces) > 1:
            for half in (pieces[: len(pieces) // 2], pieces[len(pieces) // 2 :]):
                yield from self._runs(half)

    def align(self, pieces: list[str]) -> Iterator[Aligned]:
        """Distinct pieces in runs that are encoded together; those that are not spelled are left out."""
        held: dict[bool, list[str]] = {True: [], False: []}  # of Latin letters, of others
        size = {True: 0, False: 0}
        for p in pieces:
            if self.ends_blank(p):  # would join the white space of the next
                yield from (self._run(*run) for run in self._runs([p]))
                continue
            kind = latin(p)
            held[kind].append(p)
            size[kind] += len(p)
            if size[kind] > CALL_CHARS:
                yield from (self._run(*run) for run in self._runs(held[kind]))
                held[kind], size[kind] = [], 0
        for left in held.values():
            if left:
                yield from (self._run(*run) for run in self._runs(left))

    def _run(self, pieces: list[str], a: np.ndarray, b: np.ndarray) -> Aligned:
        piece_ends = np.cumsum([len(p.encode()) for p in pieces])
        common, cuts = common_groups(*[np.cumsum(size[ids]).tolist() for size, ids in zip(self.sizes, (a, b))])
        common = np.array(common)
        sizes = [np.diff(c, prepend=0) for c in cuts]  # tokens per group
        last = np.searchsorted(common, piece_ends)  # a piece's last group
        if not np.array_equal(common[last], piece_ends):
            raise ValueError("a token reaches across the start of white space")
        per_piece = np.diff(last, prepend=-1)
        piece = np.repeat(np.arange(len(pieces)), per_piece)  # of each group
        # the groups as text: A's ids, then B's, group by group
        group = [np.repeat(np.arange(len(common)), n) for n in sizes]
        starts = np.cumsum(sizes[0] + sizes[1]) - sizes[0] - sizes[1]
        codes = np.empty(len(a) + len(b), np.int64)
        at_a = np.arange(len(a)) - (cuts[0] - sizes[0])[group[0]] + starts[group[0]]
        at_b = np.arange(len(b)) - (cuts[1] - sizes[1])[group[1]] + (starts + sizes[0])[group[1]]
        codes[at_a], codes[at_b] = a + self.kinds[0], b + self.kinds[2]
        codes[at_a[cuts[0] - 1]] += self.kinds[1] - self.kinds[0]
        codes[at_b[cuts[1] - 1]] += self.kinds[3] - self.kinds[2]
        codes[at_b[cuts[1][last] - 1]] += self.kinds[4] - self.kinds[3]
        texts = "".join(map(self.printed.__getitem__, codes.tolist())).split("\n")[:-1]
        links = np.bincount(piece, sizes[0] * sizes[1], len(pieces)).astype(np.int64)
        tokens = [np.bincount(piece, n, len(pieces)).astype(np.int64) for n in sizes]
        return Aligned(pieces, texts, np.c_[tokens[0], tokens[1], per_piece, links], *_links(a, b, cuts, sizes, group[0], piece))


class Aligned(NamedTuple):
    """Aligned pieces: groups as text, numbers of tokens (A, B), groups and links, and linked id pairs with repeats by piece."""

    pieces: list[str]
    groups: list[str]
    numbers: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    piece: np.ndarray


def common_groups(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], tuple[np.ndarray, np.ndarray]]:
    """Common ends in order, and for both sides the number of tokens up to each."""
    a_at = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    b_at = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return common, tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (a_at, b_at))


def _links(a, b, cuts, sizes, group_a, piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all groups as id pairs with repeats and their piece; large groups by their distinct ids."""
    large = np.flatnonzero(sizes[0] * sizes[1] > LARGE_GROUP)
    small_a = ~np.isin(group_a, large) if len(large) else slice(None)
    of = group_a[small_a]
    bounds = np.r_[0, cuts[1]]
    fan = np.diff(bounds)[of]
    pairs = [np.repeat(a[small_a] << 32, fan) | b[_segments(bounds, of)]]
    times, where = [np.ones(len(pairs[0]), np.int64)], [np.repeat(piece[of], fan)]
    for g in large:
        (x, n), (y, m) = [np.unique(ids[cut[g] - size[g] : cut[g]], return_counts=True) for ids, cut, size in zip((a, b), cuts, sizes)]
        pairs.append(((x << 32)[:, None] | y).ravel())
        times.append((n[:, None] * m).ravel())
        where.append(np.full(len(pairs[-1]), piece[g]))
    if not len(large):
        return pairs[0], times[0], where[0]
    pairs, times, where = map(np.concatenate, (pairs, times, where))
    order = np.argsort(where, kind="stable")
    return pairs[order], times[order], where[order]


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _MADE:
        _MADE[path_a, path_b] = Aligner(path_a, path_b)
    return _MADE[path_a, path_b]


def _segments(starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the ranges ``starts[i]:starts[i + 1]`` for each i of ``which``, in a row."""
    sizes = starts[which + 1] - starts[which]
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts[which] - before, sizes)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    return total[starts[1:]] - total[starts[:-1]]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def _coded(tool: Aligner, texts: list[str]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Distinct pieces with numbers, the numbers text after text, and where each text begins; a text's pieces are dropped at once."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    codes, starts = array("i"), np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        if t:
            codes.extend(map(number.__getitem__, tool.cut(" " + t)))
        starts[i + 1] = len(codes)
    number.default_factory = None  # it refers to its owner, which would outlive the chunk
    return number, np.frombuffer(codes, np.int32), starts


def _documents_per_pair(codes: np.ndarray, starts: np.ndarray, pair_starts: np.ndarray, place: np.ndarray, n_pairs: int) -> np.ndarray:
    """How many documents hold each pair; a run of documents of about ``SLICE_PIECES`` pieces at a time, so that lists of links stay short."""
    counts, n_pieces, begin = np.zeros(n_pairs, np.int64), max(len(pair_starts) - 1, 1), 0
    while begin < len(starts) - 1:
        end = max(int(np.searchsorted(starts, starts[begin] + SLICE_PIECES, "right")) - 1, begin + 1)
        once = _distinct(np.repeat(np.arange(end - begin), np.diff(starts[begin : end + 1])) * n_pieces + codes[starts[begin] : starts[end]])
        doc, piece = once // n_pieces, once % n_pieces
        if len(once):
            held = np.repeat(doc * n_pairs, np.diff(pair_starts)[piece]) + place[_segments(pair_starts, piece)]
            counts += np.bincount(_distinct(held) % n_pairs, minlength=n_pairs)
        begin = end
    return counts


def _chunk(tool: Aligner, ids: list, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A chunk's aligned documents as bytes, its id pairs, and how many documents hold each."""
    number, codes, starts = _coded(tool, texts)
    parts: dict[str, list[np.ndarray]] = {n: [np.empty(0, np.int64)] for n in ("pairs", "times", "per_piece")}
    numbers, groups, at = [np.empty((0, 4), np.int64)], [], np.full(len(number) + 1, -1, np.int32)
    aligned = 0
    for run in tool.align(list(number)):
        at[[number[p] for p in run.pieces]] = np.arange(aligned, aligned + len(run.pieces))
        aligned += len(run.pieces)
        numbers.append(run.numbers)
        groups.append("\n".join(run.groups).encode())
        parts["pairs"].append(run.pairs)
        parts["times"].append(run.times)
        parts["per_piece"].append(np.bincount(run.piece, minlength=len(run.pieces)))
    del number
    codes = at[codes]
    lengths = np.diff(starts)
    spelled = _sums((codes < 0).astype(np.int64), starts) == 0  # else a document has no tokens
    codes = codes[np.repeat(spelled, lengths)]
    starts = np.r_[0, np.cumsum(lengths * spelled)]
    flat, times, per_piece = (np.concatenate(parts.pop(n)) for n in ("pairs", "times", "per_piece"))
    pair_starts = np.r_[0, np.cumsum(per_piece)]
    pairs = _distinct(flat)
    place = np.searchsorted(pairs, flat).astype(np.int32)
    del flat
    counts = _documents_per_pair(codes, starts, pair_starts, place, len(pairs))
    out = io.BytesIO()
    np.savez(
        out, ids=np.array([i or 0 for i in ids], np.int64), no_id=np.array([i is None for i in ids]), starts=starts, codes=codes,
        numbers=np.concatenate(numbers), pair_starts=pair_starts, place=place, times=times,
        groups=np.frombuffer(b"\n".join(groups), np.uint8),
    )
    return zstandard.ZstdCompressor(level=1).compress(out.getbuffer()), pairs, counts


def align_chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(chunk, block, pairs, counts)``, written: aligned documents and the documents per id pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, part, done, ids, texts, size = aligner(path_a, path_b), TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            block, pairs, counts = _chunk(tool, ids, texts)
            columns = [pa.array([(part << 32) + done]), pa.array([block], pa.binary()), pa.array([pairs]), pa.array([counts])]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "block", "pairs", "counts"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK_CHARS or len(ids) >= 50_000:
                    yield close()
                    done, ids, texts, size = done + 1, [], [], 0
                    give_back()
        if ids:
            yield close()
            ids, texts = [], []
            give_back()

    return cut_lineage(only(docs, "doc_id", "text").mapInArrow(run, "chunk long, block binary, pairs array<long>, counts array<long>"))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold an id pair linked, and whether no pair of its A id has more."""
    listed = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    counts = listed.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))  # at most one row per id of B
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligned documents: ``RESULTS``.

    ``groups`` lists a document's groups, ``a1,a2|b1;a3|b2,b3`` in decimal ids.  ``n_best`` counts
    links whose pair is in as many documents as any of its A id, ``count_sum`` sums all links' counts.
    """
    chunks = align_chunks(docs, path_a, path_b)
    listed = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    found = listed.join(pair_counts(chunks), "pair").select("chunk", "at", "n", "best")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right["at"].to_numpy()
        n[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy().astype(np.int64)
        with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(left["block"][0].as_py()))) as x:
            codes, starts, place, times = x["codes"], x["starts"], x["place"], x["times"]
            per_piece = np.c_[x["numbers"], _sums(times * best[place], x["pair_starts"]), _sums(times * n[place], x["pair_starts"])]
            columns = [_sums(per_piece[codes, c], starts) for c in range(6)]
            groups = x["groups"].tobytes().decode().split("\n")
            texts = [";".join([groups[c] for c in codes[s:e].tolist()]) for s, e in zip(starts[:-1], starts[1:])]
            ids = pa.array(x["ids"], mask=x["no_id"])
        del groups, codes, place, times, per_piece, n, best, at
        give_back()
        return pa.table([ids, *[pa.array(c) for c in columns], pa.array(texts, pa.string())], names=RESULTS)

    parts = task_count(docs.sparkSession)
    left, right = chunks.select("chunk", "block").toDF("of", "block").repartition(parts, "of"), found.repartition(parts, "chunk")
    return left.groupBy("of").cogroup(right.groupBy("chunk")).applyInArrow(finish, SCHEMA)
