"""Ratios over arrays of pairs equal their definitions on two strings."""

import random

import numpy as np
import pytest

from kindred.functions import fuzzy


def texts(rng, n):
    words = ["de", "fc", "silva", "da", "garcia", "müller", "o'neil", "x", "日本", "van", "der", "berg", "pérez"]
    out = ["", " ", "  de ", "fc", "de de fc", "fc de", "a" * 64, "a" * 65, "ab" * 100, "silva " * 40, "日" * 130, " ".join(words * 4)]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.5:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))))
        elif kind < 0.8:
            out.append("".join(rng.choice("abcde ") for _ in range(rng.randint(1, 30))))
        else:
            out.append("".join(rng.choice("abcdefgh  ") for _ in range(rng.randint(60, 210))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_the_definitions(seed):
    rng = random.Random(seed)
    left, right = texts(rng, 45), texts(rng, 45)
    qi, ci = (x.ravel() for x in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
    a, b = fuzzy.Tokens(left), fuzzy.Tokens(right)
    found = {
        "lcs": fuzzy.lcs_pairs(left, right, qi, ci), "partial": fuzzy.partial_pairs(left, right, qi, ci),
        "set": fuzzy.token_set_pairs(a, b, qi, ci)[0], "weighted": fuzzy.weighted_pairs(a, b, qi, ci),
    }
    one = {"lcs": fuzzy.lcs_length, "partial": fuzzy.partial, "set": fuzzy.token_set, "weighted": fuzzy.weighted}
    for name, values in found.items():
        expected = np.array([one[name](left[i], right[j]) for i, j in zip(qi, ci)])
        wrong = np.flatnonzero(np.abs(values - expected) > 1e-9)
        assert not len(wrong), (name, [(left[qi[w]], right[ci[w]], values[w], expected[w]) for w in wrong[:3]])


def test_no_pairs():
    none, t = np.empty(0, np.int64), fuzzy.Tokens(["a"])
    assert len(fuzzy.weighted_pairs(t, t, none, none)) == 0 and len(fuzzy.lcs_pairs([], [], none, none)) == 0
