"""Search by pivots gives the rows of the plain grid and of brute force, with fewer pairs scored."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import cells
from kindred.operators import retrieval as R


def clustered(n, centres, dims=12, noise=0.05, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * noise


def table(spark, vectors, extra=()):
    pos = ["ST", "GK", "CB, LB", None]
    rows = [(i, v.tolist(), pos[i % 4], float(i % 90) if i % 7 else None) for i, v in enumerate(vectors)]
    rows += [(len(rows) + i, v, "ST", 1.0) for i, v in enumerate(extra)]
    return spark.createDataFrame(rows, "row_id long, vec array<double>, pos string, market_value_eur double").repartition(3)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "row_id", "score").collect())


def test_cells_give_the_rows_of_the_grid(spark):
    same = [1.0] + [0.0] * 11
    p = table(spark, clustered(400, 12), [None, [0.0] * 12, [0.0] * 12, *[same] * 30, [-x for x in same]])
    limits = [
        p.select(F.col("row_id").alias("query_id"), "vec"),
        p.select(F.col("row_id").alias("query_id"), "vec", F.col("row_id").alias("exclude_row_id"), F.lit("gk").alias("want_pos")),
        p.select(F.col("row_id").alias("query_id"), "vec", (F.col("row_id") % 50 + 0.5).alias("max_value"), F.lit(0.7).alias("min_similarity")),
    ]
    for queries in limits:
        assert rows_of(R.nearest(p, queries, {"vec": 1.0}, 5, method="cells")) == rows_of(R.nearest(p, queries, {"vec": 1.0}, 5, method="grid"))


def test_cells_equal_brute_force_on_vectors_without_clusters(spark):
    v = np.random.default_rng(5).normal(size=(150, 6))
    p = table(spark, v)
    found = rows_of(R.nearest(p, p.select(F.col("row_id").alias("query_id"), "vec"), {"vec": 2.0}, 3, method="cells"))
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    scores = np.round(unit @ unit.T, R.SCORE_DECIMALS)
    for q in range(150):
        order = sorted(range(150), key=lambda c: (-scores[q, c], c))[:3]
        assert [r[2] for r in found if r[0] == q] == order


def test_less_than_a_third_of_clustered_pairs_is_scored(spark):
    p = table(spark, clustered(3000, 60, 24)).select("row_id", "vec").cache()
    queries = p.select(F.col("row_id").alias("query_id"), "vec").cache()
    scored = spark.sparkContext.accumulator(0)
    kernel = R.CosineKernel({"vec": 1.0}, 10)
    found = cells.cell_matches(queries, p, kernel, 10, (3000, 3000), scored)
    assert rows_of(found) == rows_of(R.nearest(p, queries, {"vec": 1.0}, 10, method="grid"))
    assert 0 < scored.value < 3000 * 3000 / 3, scored.value


def test_cells_of_empty_tables_and_of_zero_vectors(spark):
    p = table(spark, np.zeros((20, 4)))
    queries = p.select(F.col("row_id").alias("query_id"), "vec")
    assert rows_of(R.nearest(p, queries, {"vec": 1.0}, 2, method="cells")) == [(q, r + 1, r, 0.0) for q in range(20) for r in range(2)]
    assert R.nearest(p.limit(0), queries, {"vec": 1.0}, 2, method="cells").count() == 0
    some = table(spark, clustered(20, 2, 4))
    assert R.nearest(some, queries.limit(0), {"vec": 1.0}, 2, method="cells").count() == 0
    with pytest.raises(ValueError):
        R.nearest(p, queries, {"vec": 1.0}, 2, method="tree")
