"""Near-duplicate operators against all pairs."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from kindred.llm import cap_filters as C
from kindred.llm import simhash as S
from kindred.llm import suffix_dedup as D
from kindred.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in pairs:
        a, b = find(int(i)), find(int(j))
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(90)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert [found.get(i, i) for i in range(600)] == roots(600, edges)


@pytest.mark.parametrize("limits", [(1 << 18, 64), (7, 1)])
def test_trie_pairs_are_all_pairs_within_the_budget(monkeypatch, limits):
    monkeypatch.setattr(S, "FRONTIER", limits[0] * 8)
    monkeypatch.setattr(S, "LEAF_PAIRS", limits[1])
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2)
    near = [base, np.arange(40, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(9, dtype=np.uint64)]
    for _ in range(6):
        y = base.copy()
        for _ in range(int(rng.integers(1, 4))):
            y ^= np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
        near.append(y)
    a = np.unique(np.concatenate(near))
    b, rest = a[::3], np.setdiff1d(a, a[::3])
    close = lambda x, y: np.bitwise_count(x[:, None] ^ y[None]) <= 2
    alone = [(int(i), int(j)) for x in S.trie_pairs(a, None) for i, j in zip(*x)]
    assert sorted(alone) == sorted((int(i), int(j)) for i, j in zip(*np.nonzero(close(a, a))) if i < j)
    both = [(int(i), int(j)) for x in S.trie_pairs(rest, b) for i, j in zip(*x)]
    assert sorted(both) == sorted((int(i), int(j)) for i, j in zip(*np.nonzero(close(rest, b))))


def test_simhash_equals_all_pairs(spark, nasty, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    for i, (_, t) in enumerate(docs[-30:]):  # near copies
        docs.append((1000 + i, (t or "") + " tail"))
    found = S.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    prints = [plain_fingerprint(t) for _, t in docs]
    root = roots(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    least = {}
    for (i, _), r in zip(docs, root):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    expected = [(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(docs, prints, root)]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in found)
    assert S.near_duplicates(no_docs).count() == 0


def test_crowded_trie_nodes_are_split(spark, monkeypatch):
    monkeypatch.setattr(S, "NODE_ROWS", 4)
    monkeypatch.setattr(S, "LEAST_DEPTH", 2)
    rng = np.random.default_rng(2)
    fps = np.unique(np.concatenate([np.arange(90, dtype=np.uint64), rng.integers(0, 2**63, 60, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = connected_components(S.fingerprint_links(df, 8)).collect()
    got = {r["node"]: r["root"] for r in links}
    pairs = zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 2))
    expected = roots(len(fps), pairs)
    of = lambda i: got.get(int(fps.view(np.int64)[i]), int(fps.view(np.int64)[i]))
    assert all((of(i) == of(j)) == (expected[i] == expected[j]) for i in range(len(fps)) for j in range(i))


def test_links_beyond_two_bits(spark):
    top = [0, 0b111 << 61, 0b111 << 40, 0b1111 << 60, 0b11011 << 59]
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in top], "fp long")
    got = {r["node"]: r["root"] for r in connected_components(S.fingerprint_links(df, 5, budget=3)).collect()}
    of = lambda x: got.get(x - (1 << 64) if x >> 63 else x, x - (1 << 64) if x >> 63 else x)
    expected = roots(5, [(i, j) for i in range(5) for j in range(i) if (top[i] ^ top[j]).bit_count() <= 3])
    assert all((of(top[i]) == of(top[j])) == (expected[i] == expected[j]) for i in range(5) for j in range(i))


def test_one_document_of_each_group_stays(nasty, no_docs):
    kept = S.one_of_each(nasty)
    assert kept.columns == nasty.columns
    rows = kept.collect()
    prints = [plain_fingerprint(r["text"]) for r in nasty.collect()]
    n = len(prints)
    assert len(rows) == len(set(roots(n, [(i, j) for i in range(n) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])))
    assert sum(r["doc_id"] == 9 for r in rows) == 1 and all(r["score"] == "own" and r["_t"] == 7 for r in rows)
    assert S.one_of_each(no_docs).count() == 0


def vectors(n=1200, dim=24, seed=4):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim)).astype(np.float32)
    for i in range(0, n // 2, 3):  # pairs at about 0.98 to 0.999
        v[i + 1] = v[i] + rng.standard_normal(dim).astype(np.float32) * rng.uniform(0.02, 0.19)
    v[900:1000] = v[899] + rng.standard_normal((100, dim)).astype(np.float32) * 0.05
    v[1000:1040] = v[1000]
    return [(i, [float(x) for x in row], int(i % 3 == 0) if i < 600 else 2) for i, row in enumerate(v)]


@pytest.mark.parametrize("hot", [4096, 16])
def test_cap_filters_recall_and_precision(spark, monkeypatch, hot):
    monkeypatch.setattr(C, "HOT_ROWS", hot)
    rows = [(i, v, 5 if i < 600 else 2) for i, v, _ in vectors()]
    odd = [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [1.0, None], 1), (2004, [float("nan")] * 24, 1), (2005, [1.0] * 24, None),
           (2006, [float("inf")] * 24, 1), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (None, [3.0, 1.0], 1), (2009, [3.0], 1), (2010, [-2.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumnRenamed("vec_id", "vec_id")
    found = {r["vec_id"]: r for r in C.near_duplicate_vectors(df).collect()}
    assert len(found) == len({r[0] for r in rows + odd})
    total = got = 0
    for label in (5, 2):
        ids = [r[0] for r in rows if r[2] == label]
        u = np.array([r[1] for r in rows if r[2] == label])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        near = u @ u.T >= 0.98
        np.fill_diagonal(near, False)
        for i, n in zip(ids, near.sum(axis=1)):
            assert found[i]["n_links"] <= n and found[i]["kept"] == (found[i]["component_id"] == i)
            total, got = total + n, got + found[i]["n_links"]
    assert total > 4000 and got >= 0.97 * total
    for i in (2000, 2001, 2002, 2003, 2004, 2005, 2006, 2009, 2010):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert (found[2007]["n_links"], found[2008]["n_links"], found[2008]["component_id"]) == (2, 2, 2007)
    assert found[None]["n_links"] == 0
    assert C.near_duplicate_vectors(df.limit(0)).count() == 0


def test_a_hot_bucket_counts_each_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(0)
    one = rng.standard_normal(32)
    many = [(i, [float(x) for x in one + rng.standard_normal(32) * 0.03], 1) for i in range(300)]
    monkeypatch.setattr(C, "HOT_ROWS", 64)
    df = spark.createDataFrame(many, "vec_id long, embedding array<float>, label int")
    u = np.array([r[1] for r in many], dtype=np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    n = (u @ u.T >= 0.98).sum(axis=1) - 1
    found = {r["vec_id"]: r["n_links"] for r in C.near_duplicate_vectors(df).collect()}
    assert [found[i] for i in range(300)] == n.tolist()


def plain_substrings(texts):
    count = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1 << 16, 2])
def test_suffix_dedup_equals_plain(spark, monkeypatch, hot):
    monkeypatch.setattr(D, "HOT_TOKENS", hot)
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(150, 900))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            fresh = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 200)))
            text += fresh if rng.random() < 0.5 else p[rng.randint(0, len(p) // 2) : rng.randint(len(p) // 2, len(p))]
        rows.append((i, text))
    rows += [(500, "a" * 1000), (501, "b" * 199), (502, "b" * 200), (503, "ab" * 300), (504, None), (505, ""), (506, rows[3][1]),
             (507, "x" * 230 + "y" * 230), (508, "z" * 201), (509, "same" * 60), (509, "same" * 60), (None, "q" * 150 + passages[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in D.suffix_dedup(df).collect()]
    expected = [(i, *x) for (i, _), x in zip(rows, plain_substrings([(t or "").encode() for _, t in rows]))]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert D.suffix_dedup(df.limit(0)).count() == 0


def test_runs_cover_all_strings_and_follow_their_bytes(monkeypatch):
    rng = random.Random(7)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 199, 200, 201, 900, 5000)] + [b"q" * 700]
    whole = {}
    for chunk in (1 << 18, 1000, 300):
        monkeypatch.setattr(D, "CHUNK", chunk)
        starts, anchors = collections.Counter(), {}
        for owner, anchor, start, stop, _, off in D.anchor_runs(texts):
            for o, a, s, e, d in zip(owner.tolist(), anchor.tolist(), start.tolist(), stop.tolist(), off.tolist()):
                starts.update((o, p) for p in range(s, e + 1))
                anchors |= {(o, p): (a, s + d) for p in range(s, e + 1)}
        assert starts == {(i, p): 1 for i, t in enumerate(texts) for p in range(len(t) - 199)}
        whole = whole or anchors
        assert anchors == whole  # anchors do not depend on how texts are cut


def test_suffix_sort_orders_and_verifies():
    rng = random.Random(6)
    data = bytes(rng.choice(b"ab") for _ in range(900))
    sorter = D.SuffixSorter(np.frombuffer(data, dtype=np.uint8))
    start = np.array([rng.randrange(900) for _ in range(150)])
    length, segment = 900 - start, np.array([rng.randrange(3) for _ in range(150)])
    order = sorter.sort(segment, start, length)
    assert order.tolist() == sorted(range(150), key=lambda i: (segment[i], data[start[i] :], i))
    a, b = order[:-1], order[1:]
    most = np.minimum(length[a], length[b])
    common = sorter.extension(start[a], start[b], most)
    assert (sorter.verified(start[a], start[b], common) == common).all()
    wrong = np.minimum(common + 1, most)  # as if a hash had collided
    assert (sorter.verified(start[a], start[b], wrong) == common).all()


def test_suffix_dedup_tells_texts_of_one_id_and_one_32_bit_hash_apart(spark):
    passage = "".join(f"passage {k:03d}, " for k in range(25))
    rows = [(None, f"{passage}33448"), (None, "short 196485"), (1, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len({r[0] for r in df.where("doc_id IS NULL").selectExpr("hash(text)").collect()}) == 1
    assert sorted((r["n_bytes"], r["n_removed"]) for r in D.suffix_dedup(df).collect()) == [(12, 0), (325, 325), (330, 325)]


def test_suffix_dedup_of_many_equal_rows_and_of_near_copies(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    equal = " ".join(word() for _ in range(300))
    base = [word() for _ in range(90)]
    rows = [(None, equal)] * 1500 + [(7, equal)] * 500
    for i in range(150):
        near = list(base)
        near[rng.randrange(90)] = word()
        rows.append((1000 + i, " ".join(near)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in D.suffix_dedup(df).collect())
    # two of the equal rows are as good as all to the plain search
    few = rows[:2] + rows[2000:]
    expected = [(i, *x) for (i, _), x in zip(few, plain_substrings([t.encode() for _, t in few]))]
    assert found.pop(expected[0]) == 1500 and found.pop((7, *expected[0][1:])) == 500
    assert found == collections.Counter(expected[2:])
