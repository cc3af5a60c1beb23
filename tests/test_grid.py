"""Block search by cells of a grid: work per pair, and the rows that come of it."""

import random

import numpy as np
import pyarrow as pa
import pytest

from kindred.functions import fuzzy
from kindred.operators import blocks, linkage
from kindred.operators import retrieval as R


def made_up(rng, n):
    word = lambda k: "".join(rng.choice("etaoinshrdlucmfw") for _ in range(k))
    return [f"{rng.randint(1, 25)} brand {word(10)} {word(12)} |" for _ in range(n)]


def test_names_of_few_letters_are_seldom_scored(monkeypatch):
    """Alike names, most without a partner: bounds of letters and bigrams leave out nearly all pairs, and no match."""
    rng = random.Random(5)
    right = made_up(rng, 600)
    left = [*made_up(rng, 500), *[t[:9] + t[11:20] + "e" + t[21:] for t in right[:40]], "", "ä" * 300, "a"]
    right += ["", "ä" * 290]
    scored = 0

    def counted(a, b):
        nonlocal scored
        scored += len(a)
        return lcs(a, b)

    lcs = fuzzy.lcs_lengths
    monkeypatch.setattr(fuzzy, "lcs_lengths", counted)
    kernel = linkage.IndelKernel(85.0)
    q, c = kernel.prepare(pa.table({"text": left}), True), kernel.prepare(pa.table({"text": right}), False)
    qi, ci, score = kernel.score(q, c, np.full(len(left), -np.inf))
    found = {(i, j): s for i, j, s in zip(qi.tolist(), ci.tolist(), score.tolist())}
    expected = {(i, j): s for i, a in enumerate(left) for j, b in enumerate(right) if (s := fuzzy.ratio(a, b)) >= 85.0}
    assert found == pytest.approx(expected) and len(expected) > 40
    assert 0 < scored < 0.001 * len(left) * len(right)


@pytest.mark.parametrize("held", [1 << 30, 3000])
def test_blocks_are_prepared_once_per_cell(spark, monkeypatch, held):
    """No block is sent or prepared per pair of blocks; queries beyond a cell's bound go to more rows of the grid."""
    monkeypatch.setattr(blocks, "CANDIDATE_BLOCK_ROWS", 16)
    monkeypatch.setattr(blocks, "QUERY_BLOCK_ROWS", 16)
    monkeypatch.setattr(blocks, "PREPARED_BYTES", held)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "row_id long, vec array<double>")
    queries = df.withColumnRenamed("row_id", "query_id")
    made = spark.sparkContext.accumulator(0)

    class Counted(R.CosineKernel):
        def prepare(self, block, is_query):
            made.add(1)
            return super().prepare(block, is_query)

    cells = blocks.in_cells(queries.repartition(2), df.repartition(2), Counted({"vec": 1.0}, 3))
    rows = cells.groupBy("cell", "side").count().collect()
    found = blocks.best_in_cells(cells, Counted({"vec": 1.0}, 3), 3).collect()
    assert made.value == sum(r["count"] for r in rows)
    assert (max(r["cell"] for r in rows) + 1 >= 400 * 40 / 3000) and max(r["count"] for r in rows if r["side"] == 0) <= (26 if held > 3000 else 2)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    best = np.argsort(-np.round(unit @ unit.T, 12), axis=1, kind="stable")[:, :3]
    assert sorted((r["query_id"], r["rank"], r["row_id"]) for r in found) == [(i, k + 1, j) for i in range(400) for k, j in enumerate(best[i].tolist())]


def test_best_lists_are_ranked_seldom(monkeypatch):
    """Pairs that come in drops wait until they are many beside the rows kept; the lists end the same."""
    rng = np.random.default_rng(4)
    ranked = []
    monkeypatch.setattr(blocks, "_best", lambda *a, best=blocks._best: ranked.append(1) or best(*a))
    ids, k = np.arange(50), 10
    best, scores = blocks._Best(ids, 1, k), rng.integers(0, 500, size=(50, 4000)) / 500
    for start in range(0, 4000, 20):
        part = scores[:, start : start + 20]
        qi, ci = np.nonzero(part >= best.floor[:, None])
        best.add(qi, start + ci, part[qi, ci])
    rows = best.rows(None, ["query_id", "row_id", "score"]).to_pydict()
    expected = {(q, c) for q in range(50) for c in np.lexsort((np.arange(4000), -scores[q]))[:k].tolist()}
    assert set(zip(rows["query_id"], rows["row_id"])) == expected and len(rows["row_id"]) == 500
    assert len(ranked) < 40  # of 200 additions


@pytest.mark.parametrize("nulls_pass", [True, False])
@pytest.mark.parametrize("k", [2, 7, 60])
def test_limits_on_listed_pairs_equal_limits_on_all(k, nulls_pass):
    """Queries with and without floors, limits that leave fewer than k, unknown values, several candidate blocks."""
    rng = np.random.default_rng(k)
    n, positions = 120, ["GK", "CB,DF", "ST", None]
    vectors = np.round(rng.normal(size=(n, 6)), 1)
    value = [None if i % 5 == 0 else float(i) for i in range(n)]
    pos = [positions[i % 4] for i in range(n)]
    want = ["df" if i % 3 == 0 else "zz" if i % 3 == 1 else None for i in range(n)]
    cap = [None if i % 4 == 0 else float(i % 40) for i in range(n)]
    flag, wanted = [i % 2 for i in range(n)], [i % 7 == 0 for i in range(n)]
    group = ["a" if i % 3 else None for i in range(n)]
    queries = pa.table({
        "query_id": range(n), "exclude_row_id": range(n), "vec": list(vectors), "want_pos": want, "max_value": cap, "want_flag": wanted, "want_group": group,
    })
    rows = pa.table({"row_id": range(n), "vec": list(vectors), "pos": pos, "value": value, "flag": flag, "pos_group": [["a", "b"][i % 2] for i in range(n)]})
    kernel = R.CosineKernel({"vec": 1.0}, k, nulls_pass)
    ready, best = kernel.prepare(queries, True), blocks._Best(np.arange(n), 1, k)
    for start in range(0, n, 40):
        qi, ci, score = kernel.score(ready, kernel.prepare(rows.slice(start, 40), False), best.floor)
        best.add(qi, start + ci, score)
    out = best.rows(None, ["query_id", "row_id", "score"]).to_pydict()
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    cosine = np.round(unit @ unit.T, 12)

    def allowed(q, c):
        within = cap[q] is None or (nulls_pass if value[c] is None else value[c] <= cap[q])
        named = want[q] is None or (pos[c] is not None and want[q].upper() in pos[c])
        return q != c and within and named and (flag[c] == 1 or not wanted[q]) and (group[q] is None or c % 2 == 0)

    for q in range(n):
        expected = sorted(((-cosine[q, c], c) for c in range(n) if allowed(q, c)))[:k]
        found = sorted((-s, c) for i, c, s in zip(out["query_id"], out["row_id"], out["score"]) if i == q)
        assert [c for _, c in found] == [c for _, c in expected] or np.allclose([s for s, _ in found], [s for s, _ in expected], atol=3e-12)
