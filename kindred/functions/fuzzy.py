"""String similarity kernels.

``indel`` similarity is ``200 * LCS / (len a + len b)``: insertions and
deletions only.  The longest common subsequence is computed bit-parallel, for
arrays of pairs at once; texts of any length take several machine words.  The
functions of two strings define the ratios, those of pairs compute them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel, any length)."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        hit = free & where.get(ch, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b) / total


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best ratio among shared tokens and shared-plus-own tokens of each side."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared = " ".join(sorted(left & right))
    own_left, own_right = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if shared and (not own_left or not own_right):
        return 100.0
    full_left = f"{shared} {own_left}".strip()
    full_right = f"{shared} {own_right}".strip()
    best = ratio(full_left, full_right)
    if shared:
        best = max(best, ratio(shared, full_left), ratio(shared, full_right))
    return best


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter text against windows of the longer one.

    Windows are as long as the shorter text, plus the shorter windows that
    touch either end of the longer text.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    m, n = len(short), len(long)
    if m == 0:
        return 100.0 if n == 0 else 0.0
    if short in long:
        return 100.0
    letters = set(short)
    best = 0.0
    for end in range(1, n + m):
        window = long[max(0, end - m):min(n, end)]
        edge = window[-1] if end <= n else window[0]
        if edge in letters:
            best = max(best, ratio(short, window))
    return best


def weighted(a: str, b: str) -> float:
    """Blend of plain, token and partial ratios by relative length."""
    if not a or not b:
        return 0.0
    base = ratio(a, b)
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    if longer < 1.5 * shorter:
        return max(base, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if longer <= 8 * shorter else 0.6
    sorted_a, sorted_b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    shared_token = set(a.split()) & set(b.split())
    partial_token = 100.0 if shared_token else partial(sorted_a, sorted_b)
    return max(base, scale * partial(a, b), 0.95 * scale * partial_token)


WORD = 64
PAIRS_AT_ONCE = 65_536
# Signs outside any text; a pad never equals a letter or the other side's pad.
LEFT_PAD, RIGHT_PAD = 0x10FFFE, 0x10FFFF
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def letter_codes(texts: list[str], pad: int, width: int = WORD) -> np.ndarray:
    """Matrix of character codes, one row per text, padded to ``width``; longer texts are cut."""
    packed = "".join(t[:width].ljust(width, chr(pad)) for t in texts)
    return np.frombuffer(packed.encode("utf-32-le"), dtype=np.uint32).reshape(len(texts), width)


def _narrow(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-byte codes where both sides together use fewer than 256 signs."""
    signs = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    if len(signs) > 256:
        return a, b
    return np.searchsorted(signs, a).astype(np.uint8), np.searchsorted(signs, b).astype(np.uint8)


def _places(a: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Bits of the places of ``a`` (rows of a multiple of 64 codes) that hold the row's ``sign``, as words."""
    return np.packbits(a == sign[:, None], axis=1, bitorder="little").view(np.uint64)


def _advance(free: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """One step of the bit-parallel LCS on rows of words; the sum's carry runs through a row's words."""
    hit = free & hits
    total = free + hit
    if free.shape[-1] > 1:
        carry = np.zeros(free.shape[:-1], bool)
        for w in range(free.shape[-1]):
            over = total[..., w] < free[..., w]
            total[..., w] += carry
            carry = over | (carry & (total[..., w] == 0))
    return total | (free - hit)


def _matched(free: np.ndarray) -> np.ndarray:
    """LCS length from the zero bits of a row."""
    return WORD * free.shape[-1] - np.bitwise_count(free).sum(axis=-1, dtype=np.int64)


def _lengths(texts: list[str]) -> np.ndarray:
    return np.fromiter((len(x) for x in texts), dtype=np.int64, count=len(texts))


def _word_groups(lengths: np.ndarray):
    """Places of pairs whose pattern fills the same number of words, with that number."""
    words = np.maximum(-(-lengths // WORD), 1)
    for w in np.unique(words):
        yield int(w), np.flatnonzero(words == w)


def _codes(texts: list[str], which: np.ndarray, pad: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code rows of the texts that ``which`` uses, and each use's row."""
    used, row = np.unique(which, return_inverse=True)
    return letter_codes([texts[i] for i in used.tolist()], pad, width), row


def lcs_pairs(left: list[str], right: list[str], qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """LCS length of the pairs ``(left[qi], right[ci])``, texts of any length.

    Pairs go through vectorised sweeps over the letters of ``right``; a text of ``left`` over 64
    letters takes several words per pair.
    """
    la, lb = _lengths(left), _lengths(right)
    out = np.zeros(len(qi), dtype=np.int64)
    for w, group in _word_groups(la[qi]):
        order = group[np.argsort(lb[ci[group]], kind="stable")]  # chunks of like length
        for start in range(0, len(order), PAIRS_AT_ONCE // w):
            part = order[start : start + PAIRS_AT_ONCE // w]
            steps = int(lb[ci[part]].max(initial=0))
            a, a_row = _codes(left, qi[part], LEFT_PAD, WORD * w)
            b, b_row = _codes(right, ci[part], RIGHT_PAD, max(steps, 1))
            a, b = _narrow(a, b)
            out[part] = lcs_rows(a[a_row], b[b_row], steps)
    return out


def lcs_rows(a: np.ndarray, b: np.ndarray, steps: int) -> np.ndarray:
    """LCS length of code rows; ``a`` is as wide as whole words, the first ``steps`` columns of ``b`` are read."""
    free = np.full((len(a), a.shape[1] // WORD), FULL)
    for j in range(steps):
        free = _advance(free, _places(a, b[:, j]))
    return _matched(free)


def partial_pairs(left: list[str], right: list[str], qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """:func:`partial` of every pair: all windows of the longer text slide over the shorter at once.

    A window is a column; its LCS advances by one letter per step, from the windows' own starts,
    on places of the shorter text that were looked up once per letter of the longer.
    """
    la, lb = _lengths(left), _lengths(right)
    out = np.zeros(len(qi))
    swap = la[qi] > lb[ci]
    for flip in (False, True):
        of = np.flatnonzero(swap == flip)
        short, long, si, li = (right, left, ci[of], qi[of]) if flip else (left, right, qi[of], ci[of])
        ls, ll = (lb, la) if flip else (la, lb)
        m, n = ls[si], ll[li]
        out[of[(m == 0) & (n == 0)]] = 100.0
        some = np.flatnonzero(m > 0)
        for w, group in _word_groups(m[some]):
            group = some[group]
            group = group[np.lexsort((n[group], m[group]))]
            start = 0
            while start < len(group):
                size = max(1, 4_000_000 // (w * int(m[group[start]] + n[group[min(start + 4096, len(group)) - 1]])))
                part = group[start : start + size]
                start += size
                a, a_row = _codes(short, si[part], LEFT_PAD, WORD * w)
                b, b_row = _codes(long, li[part], RIGHT_PAD, int(n[part].max()))
                a, b = _narrow(a, b)
                out[of[part]] = _best_window(a[a_row], b[b_row], m[part], n[part])
    return out


def _best_window(a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    rows, words, width, longest = np.arange(len(a)), a.shape[1] // WORD, b.shape[1], int(m.max())
    # places of each letter of the longer text, between empty margins that windows may overhang
    places = np.zeros((len(a), longest + width + longest, words), np.uint64)
    for j in range(width):
        places[:, longest + j] = _places(a, b[:, j])
    starts = np.arange(1, width + longest)  # of windows, in the margin's count; window ``e`` ends where ``partial`` ends at ``e``
    free = np.full((len(a), len(starts), words), FULL)
    for k in range(longest):
        inside = k < m
        at = (longest - m)[:, None] + starts + k
        hits = places[rows[:, None], np.minimum(at, places.shape[1] - 1)]
        hits[~inside] = 0
        free = _advance(free, hits)
    end = starts[None, :]  # letters of the longer text before the window's end
    size = np.minimum(end, n[:, None]) - np.maximum(end - m[:, None], 0)
    score = np.where(size > 0, 200.0 * _matched(free) / np.maximum(m[:, None] + size, 1), 0.0)
    return score.max(axis=1)


class Tokens:
    """Texts with what the token forms need: sorted tokens, and distinct sorted tokens as numbers of their own."""

    def __init__(self, texts: list[str]):
        self.numbers: dict[str, int] = {}
        split = [t.split() for t in texts]
        self.texts, self.sorted = texts, [" ".join(sorted(t)) for t in split]
        distinct = [sorted(set(t)) for t in split]
        self.unique = [" ".join(t) for t in distinct]
        self.count = _lengths(distinct)
        width = max(int(self.count.max(initial=0)), 1)
        self.ids = np.full((len(texts), width), -1, np.int64)
        self.sizes = np.zeros((len(texts), width), np.int64)
        for i, tokens in enumerate(distinct):
            self.ids[i, : len(tokens)] = [self.numbers.setdefault(t, len(self.numbers)) for t in tokens]
            self.sizes[i, : len(tokens)] = [len(t) for t in tokens]

    def ids_of(self, other: Tokens) -> np.ndarray:
        """The other side's token numbers as numbers of this one; negative where this has no such token."""
        known = np.fromiter((self.numbers.get(t, -1) for t in other.numbers), np.int64, len(other.numbers))
        return np.where(other.ids >= 0, np.r_[known, -1][other.ids], -1)


def _joined(sizes: np.ndarray) -> np.ndarray:
    """Length of tokens joined by blanks; zero sizes are no tokens."""
    return sizes.sum(axis=1) + np.maximum((sizes > 0).sum(axis=1) - 1, 0)


def _own_rows(side: Tokens, which: np.ndarray, shared: np.ndarray, pad: int, width: int) -> np.ndarray:
    """Code rows of the distinct sorted tokens that are not ``shared``, joined by blanks."""
    texts = [side.unique[i] for i in which.tolist()]
    codes = letter_codes(texts, pad, width).copy()
    token = np.cumsum(codes == ord(" "), axis=1)  # a blank belongs to the token after it
    token = np.minimum(token, shared.shape[1] - 1)
    drop = np.take_along_axis(shared, token, axis=1) | (codes == pad)
    order = np.argsort(drop, axis=1, kind="stable")
    codes = np.take_along_axis(codes, order, axis=1)
    codes[np.take_along_axis(drop, order, axis=1)] = pad
    lead = codes[:, 0] == ord(" ")  # the first token went
    codes[lead] = np.concatenate([codes[lead, 1:], np.full((int(lead.sum()), 1), pad, codes.dtype)], axis=1)
    return codes


def token_set_pairs(left: Tokens, right: Tokens, qi: np.ndarray, ci: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`token_set` of every pair, and whether the pair shares a token.

    What both sides begin with, the shared tokens, is part of any LCS; so only the tokens of
    their own are compared.
    """
    out, any_shared = np.zeros(len(qi)), np.zeros(len(qi), bool)
    right_ids = left.ids_of(right)
    step = max(1, 2_000_000 // (left.ids.shape[1] * right_ids.shape[1]))
    for start in range(0, len(qi), step):
        part = slice(start, start + step)
        i, j = qi[part], ci[part]
        equal = (left.ids[i][:, :, None] == right_ids[j][:, None, :]) & (left.ids[i] >= 0)[:, :, None]
        of_left, of_right = equal.any(axis=2), equal.any(axis=1)
        common = _joined(left.sizes[i] * of_left)
        own = [_joined(side.sizes[k] * ~s) for side, k, s in ((left, i, of_left), (right, j, of_right))]
        has = of_left.any(axis=1)
        any_shared[part] = has
        score = np.zeros(len(i))
        alone = np.flatnonzero(~has & (left.count[i] > 0) & (right.count[j] > 0))
        lcs = lcs_pairs(left.unique, right.unique, i[alone], j[alone])
        score[alone] = 200.0 * lcs / (own[0][alone] + own[1][alone])
        score[has & ((own[0] == 0) | (own[1] == 0))] = 100.0
        both = np.flatnonzero(has & (own[0] > 0) & (own[1] > 0))
        for w, group in _word_groups(own[0][both]):
            group = both[group]
            # rows are as wide as the whole texts, so go in chunks of bounded size
            wide = max(max(len(left.unique[x]) for x in i[group].tolist()), max(len(right.unique[x]) for x in j[group].tolist()), WORD * w)
            wide += -wide % WORD
            for at in range(0, len(group), max(1, 4_000_000 // wide)):
                g = group[at : at + max(1, 4_000_000 // wide)]
                a = _own_rows(left, i[g], of_left[g], LEFT_PAD, wide)[:, : WORD * w]
                b = _own_rows(right, j[g], of_right[g], RIGHT_PAD, wide)
                a, b = _narrow(a, b)
                shared_lcs = common[g] + 1 + lcs_rows(a, b, int(own[1][g].max()))
                full = [common[g] + 1 + o[g] for o in own]
                best = 200.0 * shared_lcs / (full[0] + full[1])
                for o in full:
                    best = np.maximum(best, 200.0 * common[g] / (common[g] + o))
                score[g] = best
        out[part] = score
    return out, any_shared


def weighted_pairs(left: Tokens, right: Tokens, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """:func:`weighted` of the pairs ``(left[qi], right[ci])`` over arrays of pairs."""
    la, lb = _lengths(left.texts)[qi], _lengths(right.texts)[ci]
    long, short = np.maximum(la, lb), np.minimum(la, lb)
    out = np.zeros(len(qi))
    known = np.flatnonzero(short > 0)
    out[known] = 200.0 * lcs_pairs(left.texts, right.texts, qi[known], ci[known]) / (la + lb)[known]
    near = known[long[known] < 1.5 * short[known]]
    far = known[long[known] >= 1.5 * short[known]]
    sizes = _lengths(left.sorted)[qi[near]] + _lengths(right.sorted)[ci[near]]
    in_order = np.where(sizes > 0, 200.0 * lcs_pairs(left.sorted, right.sorted, qi[near], ci[near]) / np.maximum(sizes, 1), 100.0)
    out[near] = np.maximum(out[near], 0.95 * np.maximum(in_order, token_set_pairs(left, right, qi[near], ci[near])[0]))
    scale = np.where(long[far] <= 8 * short[far], 0.9, 0.6)
    part = partial_pairs(left.texts, right.texts, qi[far], ci[far])
    shared = token_set_pairs(left, right, qi[far], ci[far])[1]
    token_part = np.full(len(far), 100.0)
    token_part[~shared] = partial_pairs(left.sorted, right.sorted, qi[far[~shared]], ci[far[~shared]])
    out[far] = np.maximum(out[far], np.maximum(scale * part, 0.95 * scale * token_part))
    return out


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """LCS length of each aligned pair."""
    both = np.arange(len(left))
    return lcs_pairs(left, right, both, both)


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Indel similarity 0-100 of two text columns; NULL when either is NULL."""
    known = (left.notna() & right.notna()).to_numpy()
    a, b = left[known].tolist(), right[known].tolist()
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], dtype=float)
    out = np.full(len(left), np.nan)
    out[known] = np.where(total == 0, 100.0, 200.0 * lcs_lengths(a, b) / np.maximum(total, 1.0))
    return pd.Series(out).astype("Float64").mask(pd.Series(~known))
