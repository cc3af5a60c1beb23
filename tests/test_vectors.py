"""Cosines in numpy against the JVM's."""

import random

from pyspark.sql import functions as F

from kindred.functions import vectors as V


def test_numpy_cosine_is_the_jvm_cosine(spark, monkeypatch):
    monkeypatch.setattr(V, "ROWS_AT_ONCE", 7)
    rng = random.Random(1)
    made = lambda n: [round(rng.uniform(-1, 1), 6) for _ in range(n)]
    rows = [(made(9), made(9)) for _ in range(60)]
    rows += [(None, made(3)), (made(3), None), ([0.0] * 3, made(3)), (made(3), made(4)), ([0.0] * 3, made(4)), ([1.0, None], [1.0, 2.0]), ([], []), ([], [1.0])]
    rows += [([float("nan"), 1.0], [1.0, 1.0]), ([1e200, 1.0], [1e200, 1.0]), ([1e-200], [1e-200])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a array<double>, b array<double>").repartition(3)
    for kind in ("double", "float"):
        a, b = (F.col(c).cast(f"array<{kind}>") for c in "ab")
        both = df.withColumn("x", a).withColumn("y", b).select("id", V.cosine(F.col("x"), F.col("y")).alias("jvm"), V.numpy_cosine("x", "y").alias("np"))
        assert [repr(r["jvm"]) for r in both.orderBy("id").collect()] == [repr(r["np"]) for r in both.orderBy("id").collect()]

