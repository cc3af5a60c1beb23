"""Texts as pieces that tokenizers treat alone, and a bounded cache over them.

The patterns of the tokenizers used here never let a token span the start of a run of white
space, so a text may be cut before each run and the pieces encoded one by one.  Words repeat,
so a worker keeps the results of pieces it has seen; only new ones meet a tokenizer.
"""

from __future__ import annotations

import contextlib
import ctypes
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Unicode white space, as the tokenizers' patterns understand ``\s``.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
#: Pieces a worker remembers, the longest it does, and texts encoded together (documents, characters).
CACHE_PIECES, CACHE_CHARS = 600_000, 64
GROUP_DOCS, GROUP_CHARS = 256, 2_000_000
#: Letters that every version of Unicode classes alike, runs of blanks too long to look back over, and how a byte-level vocabulary splits.
LATIN_SIGNS = re.compile("[\t-\r -~\xa1-\u024f]*").fullmatch
LONG_BLANKS = re.compile("[\t-\r ]{100}").search
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def give_back() -> None:
    """Return freed memory to the system: workers live on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def grouped(batch: pa.RecordBatch, column: int, most_chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in groups of bounded size, each with the place of its first row."""
    group, chars, start = [], 0, 0
    for i, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        group.append(text)
        chars += len(text)
        if len(group) >= GROUP_DOCS or chars >= most_chars:
            yield start, group
            group, chars, start = [], 0, i + 1
    if group:
        yield start, group


class AgingCache:
    """Ids of texts as unsigned 16-bit bytes; ``encode`` gives them for a list of new pieces.

    A cache of two generations: what the younger has not seen is looked up in the older before it is new.
    Both together keep about ``most`` pieces, and what one group of texts has beyond that.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = CACHE_PIECES):
        self.encode, self.most, self.known, self.older = encode, most, {}, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [PIECES(t) for t in texts]
        get = self.of(set().union(*cut)).__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]

    def of(self, every: set[str]) -> dict[str, bytes]:
        """Ids of all pieces of ``every``, among others; long pieces are not kept."""
        if len(self.known) + len(every) > self.most // 2:
            self.known, self.older = {}, self.known
        missing = every.difference(self.known)
        found = {p: self.older[p] for p in missing.intersection(self.older)}
        new = list(missing.difference(found))
        long = {}
        for p, x in zip(new, self.encode(new)):
            (found if len(p) <= CACHE_CHARS else long)[p] = x
        self.known.update(found)
        return self.known | long if long else self.known


def byte_names(path: str) -> list[bytes]:
    """What each id of a byte-level vocabulary file spells; an added token spells its name."""
    from tokenizers import Tokenizer, pre_tokenizers

    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    codes = [*range(0x800), *range(0x800, 0xD800, 0x40), *range(0x10000, 0x110000, 0x1000)]
    byte_of = {c: b for code in codes for b, c in zip(chr(code).encode(), level.pre_tokenize_str(chr(code))[0][0])}
    byte_of |= {chr(b): b for b in set(range(256)).difference(byte_of.values())}  # no text has them: signs of their own number
    library = Tokenizer.from_file(path)
    vocabulary, added = library.get_vocab(), library.get_added_tokens_decoder()
    names = [b""] * (1 + max(vocabulary.values()))
    for name, i in vocabulary.items():
        names[i] = name.encode() if i in added else bytes(byte_of[c] for c in name)
    return names


def latin(text: str) -> bool:
    """Whether encoders by ranks split a text surely as the tokenizers library does."""
    return LATIN_SIGNS(text) is not None and LONG_BLANKS(text) is None


def by_ranks(path: str):
    """Encoder by ranks that equals the file's own, where that is a plain byte-level one whose ids follow its merges; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    level, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = level.get("type") == "ByteLevel" and level.get("use_regex", True) and not spec.get("normalizer") and not model.get("dropout")
    made = [model["vocab"]["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")] for pair in model.get("merges", [])]
    if not plain or made != sorted(made):
        return None
    import tiktoken

    added = {x["id"] for x in spec.get("added_tokens", [])}
    ranks = {name: i for i, name in enumerate(byte_names(path)) if name and i not in added}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
