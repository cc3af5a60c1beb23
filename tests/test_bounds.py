"""Bounds of memory and of what passes through the driver, and the exactness of the narrowed search."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from kindred.functions import text as X
from kindred.operators import metrics as M
from kindred.operators import retrieval as R
from kindred.operators.blocks import _held


def test_folding_holds_a_few_texts_at_a_time():
    texts = pa.array([("é" + "x" * 5000)] * 2000)
    tracemalloc.start()
    folded = X._each(texts, lambda x: X._fold(x, False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert folded.to_pylist() == ["e" + "x" * 5000] * 2000 and peak < 8e6  # of 20 MB
    assert X._each(pa.array([], pa.string()), str).to_pylist() == []
    assert X._each(pa.array([None, "Ö"]), lambda x: X._fold(x, True)).to_pylist() == ["", "o"]


def test_prepared_blocks_are_counted_by_their_arrays():
    assert _held({"a": np.zeros(10), "b": (["x"], np.zeros(3)), "c": [{"d": np.zeros(2)}]}) == 8 * 15


@pytest.mark.parametrize("by", ["position", "curated"])
def test_evaluation_joins_are_not_broadcast(spark, by):
    p = spark.createDataFrame([(i, f"P{i}", "GK") for i in range(9)], "row_id long, player string, pos string")
    retrieved = spark.createDataFrame([(1, 1, "P2", "v")], "row_id long, rank int, item string, embedding_type string")
    if by == "position":
        hits = M.position_hits(retrieved, *M.position_queries(p))
    else:
        hits = M.curated_hits(retrieved, *M.curated_queries(p.selectExpr("player AS query_player", "'P2' AS similar_player"), p))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") <= (by == "position")  # one row per position group


@pytest.mark.parametrize("k", [1, 3])
def test_narrowed_search_equals_plain_scores(k):
    """Cosines closer than single precision tells, equal and zero vectors, extreme lengths, a block without vectors."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    vectors = np.vstack([base, base[:5], base[:5] + 1e-8 * rng.normal(size=(5, 8)), np.zeros((1, 8)), base[:2] * 1e150, base[:2] * 1e-150])
    ids = np.arange(len(vectors))
    block = pa.table({"row_id": ids, "exclude_row_id": ids, "vec": list(vectors)})
    kernel = R.CosineKernel({"vec": 1.0}, k)
    ready = kernel.prepare(block, True)
    qi, ci, score = kernel.score(ready, kernel.prepare(block, False), np.full(len(ids), -np.inf))
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    scale = np.outer(norm, norm)
    plain = np.round(np.divide((vectors[:, None] * vectors[None]).sum(axis=2), scale, out=np.zeros_like(scale), where=scale > 0), 12)
    plain[ids, ids] = -np.inf
    for q in ids:
        want = sorted(-plain[q])[:k]
        assert np.allclose(sorted(-score[qi == q])[:k], want, rtol=0, atol=2e-12)
    none = pa.table({"row_id": ids, "vec": pa.array([None] * len(ids), pa.list_(pa.float64()))})
    _, _, score = kernel.score(ready, kernel.prepare(none, False), np.full(len(ids), -np.inf))
    assert len(score) and not score.any()
