"""BPE encoding and decoding: speculate and verify.

A word's greedy longest matches are a proposal.  By the nature of rank-ordered merging, a
sequence of tokens is the word's encoding exactly when every token encodes to itself and no
merge would ever join what stands at a boundary; so all adjacent pairs of all new words are
tested together with array operations, and only words with a failing pair are merged exactly.

For a boundary, the test goes back in time: of the two symbols beside it, the one made by the
later merge is undone, until a merge of the two would have come before the ones that really
took them (the pair fails) or both are single bytes (it holds).

Normalisation and splitting into words follow the vocabulary file through the tokenizers
library, on distinct pieces only.  Encoding is a map over documents; nothing is shuffled.

Defined cases: a NULL text counts as empty and has no ids and an empty decoding; texts and
words of any length are encoded whole; repeated rows give equal rows; an empty table gives
an empty result; other columns are kept, one named like a result column is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.expressions import carry
from kindred.llm.pieces import AgingCache, give_back, grouped

END = "</w>"
#: Symbols up to which a word is merged by looking for the lowest rank again and again.
SHORT = 24
#: Pieces whose normal form and words need no library: Latin letters only, the vocabulary file's own pattern.
LATIN = re.compile("[\\t-\\r -~\xa1-\u024f]*").fullmatch
LATIN_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
NEVER = 1 << 60
#: Words a worker remembers beside its pieces, and characters encoded together: an executor's memory is shared by its workers.
CACHE_WORDS, GROUP_CHARS = 300_000, 400_000
RESULTS = ["n_tokens", "ids_sha256", "decoded_sha256"]
_MADE: dict[str, SpeculativeBpe] = {}


class SpeculativeBpe:
    """Encoder of one vocabulary file with word ends, as the library encodes it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.at_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        n = 1 + max([*self.vocab.values(), *self.added.values()])
        self.names = [""] * n
        for name, i in [*self.vocab.items(), *self.added.items()]:
            self.names[i] = name
        self.longest = max(map(len, self.vocab))
        #: Length of the longest token inside a word by its first three characters; others have two at most.
        self.reach: dict[str, int] = {}
        for name in sorted(self.vocab, key=len):
            self.reach[name[:3]] = len(name)
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault((self.vocab[a], self.vocab[b]), rank)
        self.merged = {p: self.vocab[self.names[p[0]] + self.names[p[1]]] for p in self.ranks}
        keys = np.array([a * n + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(keys)
        self.n, self.pair_keys = n, keys[order]
        self.pair_ranks = np.fromiter(self.ranks.values(), dtype=np.int64, count=len(keys))[order]
        #: How a token is made: rank of its last merge (-1: none) and its two parts; -2: not looked at, -3: it encodes to others.
        self.rank = np.full(n, -2, dtype=np.int64)
        #: Tokens looked at that encode to themselves: 1.
        self.sure = bytearray(n)
        self.left, self.right = np.arange(n), np.arange(n)
        from tokenizers import pre_tokenizers

        #: The byte characters by byte: what the library's byte level makes of one-byte texts, learnt from two-byte ones above 127.
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        chars = {b: c for code in [*range(0x80), *range(0x80, 0x800), *range(0x10000, 0x110000, 0x1000), *range(0x800, 0xD800, 0x40)]
                 for b, c in zip(chr(code).encode(), level.pre_tokenize_str(chr(code))[0][0])}
        self.byte_chars = "".join(chars.get(b, chr(b)) for b in range(256))
        self.words = AgingCache(lambda words: [array("H", x).tobytes() for x in self.encode_words(words)], CACHE_WORDS)
        self.cache = AgingCache(self._encode_pieces)

    # -- exact merging -------------------------------------------------------------------

    def _symbols(self, word: str, ended: bool) -> list[int]:
        return [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + END if ended else word[-1]]] if word else []

    def _merge(self, ids: list[int]) -> tuple[list[int], tuple[int, int, int] | None]:
        """Ids after all merges, lowest rank and leftmost first, and the last merge made."""
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> tuple[list[int], tuple[int, int, int] | None]:
        ids, get, last = list(ids), self.ranks.get, None
        ranks = [get(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < NEVER:
            i = ranks.index(rank)
            last = (rank, ids[i], ids[i + 1])
            ids[i : i + 2] = [self.merged[last[1:]]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), NEVER)
        return ids, last

    def _merge_long(self, ids: list[int]) -> tuple[list[int], tuple[int, int, int] | None]:
        ids, n, last = list(ids), len(ids), None
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.ranks.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            last = (rank, a, b)
            ids[i], ids[j], after[i] = self.merged[a, b], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.ranks.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0], last

    def _know(self, token: int) -> bool:
        """Look at how a token is made, once; whether it encodes to itself."""
        stack = [token]
        while stack:
            t = stack.pop()
            if self.rank[t] != -2:
                continue
            name = self.names[t]
            ended = name.endswith(END) and len(name) > len(END)
            ids, last = self._merge(self._symbols(name[: -len(END)] if ended else name, ended))
            if ids != [t]:
                self.rank[t] = -3
            elif last is None:
                self.rank[t] = -1
            else:
                self.rank[t], self.left[t], self.right[t] = last
                stack += last[1:]
        self.sure[token] = int(self.rank[token] != -3)
        return self.sure[token] == 1

    # -- speculation ---------------------------------------------------------------------

    def _propose(self, word: str) -> list[int]:
        """Greedy longest matches of ``word``, of tokens that encode to themselves."""
        whole, out, i, n = word + END, [], 0, len(word)
        vocab, sure, know, reach, total = self.vocab, self.sure, self._know, self.reach.get, len(word) + len(END)
        while i < n:
            token = vocab.get(whole[i:]) if total - i <= self.longest else None
            if token is not None and (sure[token] or know(token)):
                out.append(token)
                break
            for j in range(min(n - 1, i + reach(word[i : i + 3], 2)), i, -1):
                token = vocab.get(word[i:j])
                if token is not None and (sure[token] or know(token)):
                    break
            else:
                return []
            out.append(token)
            i = j
        return out

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves a boundary between each ``a`` and the ``b`` after it."""
        good = np.ones(len(a), dtype=bool)
        at, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        x_taken, y_taken = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(at):
            rank = self._pair_rank(x, y)
            joined = (rank < x_taken) & (rank <= y_taken) & (rank < NEVER)
            good[at[joined]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~joined & ((rx >= 0) | (ry >= 0))
            at, x, y, x_taken, y_taken, rx, ry = (v[on] for v in (at, x, y, x_taken, y_taken, rx, ry))
            undo = rx > ry  # of equal ranks the left symbol was made first
            x_taken, y_taken = np.where(undo, rx, x_taken), np.where(undo, y_taken, ry)
            x, y = np.where(undo, self.right[x], x), np.where(undo, y, self.left[y])
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words in the vocabulary's byte characters."""
        out = [self._propose(w) for w in words]
        sizes = np.fromiter(map(len, out), dtype=np.int64, count=len(out))
        flat = np.fromiter((t for w in out for t in w), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(out)), sizes)
        inside = np.flatnonzero(owner[1:] == owner[:-1]) if len(flat) else np.array([], dtype=np.int64)
        failed = set(owner[inside[~self.compatible(flat[inside], flat[inside + 1])]].tolist())
        for i in failed.union(np.flatnonzero(sizes == 0).tolist()):
            out[i] = self._merge(self._symbols(words[i], True))[0]
        return out

    # -- texts ---------------------------------------------------------------------------

    def _parts(self, piece: str) -> list[bytes | str]:
        """Added tokens (as ids) and words of a piece, in order."""
        plain = piece.lstrip(" \n")
        if plain.isascii() and plain.isalpha():
            return [plain.lower()]
        parts: list[bytes | str] = []
        for segment in self.at_added.split(piece) if self.at_added and "<|" in piece else [piece]:
            if segment in self.added:
                parts.append(array("H", [self.added[segment]]).tobytes())
            elif LATIN(segment):
                words = LATIN_WORDS(segment.lower())  # such letters are composed already
                parts += [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.byte_chars) for w in words]
            elif segment:
                parts += [w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(segment))]
        return parts

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        parts = [self._parts(p) for p in pieces]
        ids = self.words.of({w for p in parts for w in p if isinstance(w, str)})
        return [b"".join([ids[w] if isinstance(w, str) else w for w in p]) for p in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype="<u2") for x in self.cache(texts)]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by blanks: the vocabulary file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def encoder(path: str) -> SpeculativeBpe:
    """The worker's encoder of a vocabulary file; its tables are made once."""
    if path not in _MADE:
        _MADE[path] = SpeculativeBpe(path)
        give_back()  # what reading the file took
    return _MADE[path]


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Documents with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; texts go."""
    return bpe_encode(docs, path, ids=False)


def bpe_encode(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """Documents with the digests of :func:`bpe_digests` and, by choice, the array ``ids``."""
    results = [*RESULTS, "ids"] if ids else RESULTS
    others = carry(docs, ["text"], [*results, "text"], lambda rows: _encoded(rows, path, ids))
    return others.drop("text")


def _encoded(docs: DataFrame, path: str, ids: bool) -> DataFrame:
    kept = [c for c in docs.columns if c != "text"]
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if ids else []

    def run(batches):
        bpe = encoder(path)
        for batch in batches:
            for start, texts in grouped(batch, 0, GROUP_CHARS):
                encoded = bpe.encode(texts)
                columns = [
                    pa.array([len(x) for x in encoded], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in encoded], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in encoded], pa.string()),
                ]
                if ids:
                    columns.append(pa.array([x.astype("<i4") for x in encoded], pa.list_(pa.int32())))
                own = batch.slice(start, len(texts)).columns[1:]
                yield pa.RecordBatch.from_arrays([*own, *columns], names=[*kept, *[f.name for f in fields]])
            give_back()

    source = docs.select(F.col("text"), *kept)
    return source.mapInArrow(run, T.StructType([*docs.select(*kept).schema.fields, *fields])).withColumn("text", F.lit(None).cast("string"))
