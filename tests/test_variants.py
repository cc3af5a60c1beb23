"""One pass for several weights gives what a search per weight gives."""

import random

from pyspark.sql import functions as F

from kindred.operators import retrieval as R


def profiles(spark, n=150):
    rng = random.Random(3)
    rows = [(i, f"p{i}", [rng.gauss(0, 1) for _ in range(4)], [rng.gauss(0, 1) for _ in range(6)]) for i in range(n)]
    rows += [(n, "none", None, None), (n + 1, "half", [1.0, 0.0, 0.0, 0.0], None), (n + 2, "p0 again", rows[0][2], rows[0][3])]
    return spark.createDataFrame(rows, "row_id long, player string, stat array<double>, text array<double>").repartition(3)


def test_variants_equal_separate_searches(spark):
    p = profiles(spark)
    queries = p.where("row_id % 4 = 0").select(F.col("row_id").alias("query_id"), "row_id")
    variants = {"stat": {"stat": 1.0}, "text": {"text": 1.0}, "hybrid": R.stat_text_weights(0.6), "even": {"text": 0.5, "stat": 0.5}}
    together = R.Variants(p, variants)(queries, 5)
    found = {tuple(r) for r in together.select("embedding_type", "query_id", "rank", "player", "similarity").collect()}
    expected = set()
    for label, weights in variants.items():
        for r in R.find_similar(p, queries, weights, 5, columns=["player"]).collect():
            expected.add((label, r["query_id"], r["rank"], r["player"], r["similarity"]))
    assert found == expected
    assert len(found) == 4 * 5 * queries.count()


def test_variants_multiply_pairs_once(spark):
    p = profiles(spark, 40)
    queries = p.select(F.col("row_id").alias("query_id"), "row_id")
    plan = R.nearest(p, queries.join(p.drop("player"), "row_id").drop("row_id"), {"a": {"stat": 1.0}, "b": R.stat_text_weights(0.5)}, 3)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("MapInArrow") == 3  # packing of both sides and one kernel
