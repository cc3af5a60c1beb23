"""Digest buckets counted as arrays against counts of exploded terms."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import features as E

TEXTS = ["a b a c1.2 ß", "  ", None, "", "A B a", "ωμέγα 数 ٣ x_y é é é", "b " * 500, "word" * 200, "one two three four five", "\U0001d54f q"]


@pytest.mark.parametrize("partitions", [1, 3])
def test_counts_without_exploded_terms(spark, monkeypatch, partitions):
    """Keys that come twice are counted together, unknown keys too, across batches; those rows get what a join gives them."""
    monkeypatch.setattr(E, "VECTORS_AT_ONCE", 3)
    monkeypatch.setattr(E, "KNOWN_TERMS", 4)
    rows = [(i, t, f"p{i}") for i, t in enumerate(TEXTS)] + [(4, "z z b", "again"), (8, "b six", "again"), (8, None, "third"), (None, "b c", "n1"), (None, "c d", "n2")]
    df = spark.createDataFrame(rows, "row_id long, profile string, player string").repartition(partitions)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        counts = E._term_counts(df, "row_id", "profile", 16)
        idf, encoded = E.bucket_encode(df, "row_id", dims=16)
        wanted = E._vectors(df, counts, E._idf(df, counts), "row_id", 16, "text").drop("profile")
        held = E._counted(df, "row_id", "profile", 16)
        pairs = lambda d: sorted((str(r["row_id"]), r["bucket"], r["tf"]) for r in d.collect())
        found = held.select("row_id", F.explode(F.arrays_zip("buckets", "counts")).alias("x")).select("row_id", F.col("x.buckets").alias("bucket"), F.col("x.counts").alias("tf"))
        assert pairs(found) == pairs(counts)
        assert {tuple(r) for r in idf.collect()} == {tuple(r) for r in E._idf(df, counts).collect()}
        vectors = lambda d: sorted((str(r["row_id"]), r["player"], [round(x, 12) for x in r["text"]]) for r in d.collect())
        assert vectors(encoded) == vectors(wanted) and encoded.columns == wanted.columns
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_terms_are_never_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "row_id long, profile string")
    assert "Generate" not in E._counted(df, "row_id", "profile", 16)._jdf.queryExecution().executedPlan().toString()
