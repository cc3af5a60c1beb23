"""The bigram index against brute force."""

import random

import pytest

from kindred.functions import fuzzy
from kindred.operators import linkage
from kindred.operators.grams import GramIndex, matches_per_pair


def names(rng, n):
    first = ["joão", "luis", "kylian", "robert", "mohamed", "erling", "vinícius", "harry", "jude", "pedro", "federico", "bukayo", "o", ""]
    last = ["silva", "de bruyne", "mbappe", "lewandowski", "salah", "haaland", "junior", "kane", "bellingham", "fernandez", "valverde", "saka", "xy"]
    out = [f"{rng.choice(first)} {rng.choice(last)} | {rng.choice(['fc', 'real', 'inter'])} {rng.choice(last)}" for _ in range(n)]
    return out + ["", "a", "ab", "abc", "aaaaaaaa", "aaaaaaab", "ababababab", "z" * 90, "z" * 84 + "yyyyyy"]


def spoilt(rng, text):
    text = list(text)
    for _ in range(rng.randint(0, 5)):
        if text and rng.random() < 0.5:
            del text[rng.randrange(len(text))]
        else:
            text.insert(rng.randint(0, len(text)), rng.choice("abcdez "))
    return "".join(text)


@pytest.mark.parametrize("threshold", [80.0, 85.0, 90.0])
def test_index_loses_no_pair(spark, threshold):
    rng = random.Random(int(threshold))
    right = sorted(set(names(rng, 90)))
    left = sorted({spoilt(rng, t) for t in right})
    q = spark.createDataFrame(list(enumerate(left)), "query_id long, text string")
    n = spark.createDataFrame(list(enumerate(right)), "row_id long, text string")
    index = GramIndex(q, n, threshold)
    met = {tuple(r) for r in index.candidates().collect()}
    similar = {(i, j): fuzzy.ratio(a, b) for i, a in enumerate(left) for j, b in enumerate(right) if fuzzy.ratio(a, b) >= threshold}
    assert {p for p in similar if left[p[0]] != right[p[1]]} <= met  # equal texts are settled before
    assert len(met) < len(left) * len(right)
    found = {r["query_id"]: (r["row_id"], r["score"]) for r in index.best().collect()}
    for i, a in enumerate(left):
        own = [(-s, j) for (k, j), s in similar.items() if k == i]
        if own and len(a) > 1:
            assert found[i] == (min(own)[1], pytest.approx(-min(own)[0]))
        elif len(a) > 1:
            assert i not in found


def test_both_ways_agree(spark, monkeypatch):
    rng = random.Random(4)
    right = sorted(set(names(rng, 80)))
    left = sorted({spoilt(rng, t) for t in right} - set(right))
    q = spark.createDataFrame([(i, t) for i, t in enumerate(left) if len(t) > 1], "query_id long, text string")
    n = spark.createDataFrame(list(enumerate(right)), "row_id long, text string")
    results = []
    for cost in (0, 1e18):
        monkeypatch.setattr(linkage, "MATCH_COST", cost)
        results.append(sorted((r["query_id"], r["row_id"], round(r["score"], 6)) for r in linkage.best_indel(q, n, 85.0).collect()))
    assert results[0] == results[1] and results[0]


def test_work_grows_with_matches_not_with_pairs(spark):
    """Twice the rows of names that differ: candidates stay a small share of all pairs."""
    rng = random.Random(9)
    signs = "abcdefghijklmnopqrstuvwxyzáéíóúñçäöüßøåæœłśžčřéğışþðабвгдежзиклмнопрстуфхцчшщыэюя"
    shares = []
    for size in (300, 600):
        texts = ["".join(rng.choice(signs) for _ in range(18)) for _ in range(size)]
        q = spark.createDataFrame([(i, spoilt(rng, t)) for i, t in enumerate(texts)], "query_id long, text string")
        n = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
        index = GramIndex(q, n, 85.0)
        shares.append(index.candidates().count() / size**2)
        assert matches_per_pair(q, n, 85.0) == pytest.approx(index.matches() / size**2)
        assert matches_per_pair(q, n, 85.0) * linkage.MATCH_COST <= 1
    assert max(shares) < 0.05
