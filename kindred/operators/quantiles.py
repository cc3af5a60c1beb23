"""Exact interpolated quantiles of many columns without one big sort.

1. One aggregation brackets every quantile with an approximate digest of
   moderate accuracy, so that digests stay small however many tasks give one.
2. A second one brackets it again among the values inside the first bracket.
3. One pass counts what lies below each bracket and groups the few values
   inside it (map-side combined, so repeated values collapse).
4. A running count over the bracketed values picks the two order statistics.

Every size takes the same way; the digests only narrow the search.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.columns import as_double, quoted

ACCURACY = 10_000
MARGIN = 10.0 / ACCURACY
#: Steps of the second bracket, and steps kept on both sides of the wanted one.
STEPS, AROUND = 200, 3


def _brackets(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """``(feature, prob, n, lo, hi)``: one row per column and probability."""
    low = [max(p - MARGIN, 0.0) for p in probs]
    high = [min(p + MARGIN, 1.0) for p in probs]
    stats = []
    for c in columns:
        value = as_double(quoted(c))
        stats += [
            F.count(value).alias(f"n_{c}"),
            F.percentile_approx(value, low, ACCURACY).alias(f"lo_{c}"),
            F.percentile_approx(value, high, ACCURACY).alias(f"hi_{c}"),
        ]
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(p).alias("prob"), F.col(quoted(f"n_{c}")).alias("n"),
            F.get(F.col(quoted(f"lo_{c}")), F.lit(i)).alias("lo"), F.get(F.col(quoted(f"hi_{c}")), F.lit(i)).alias("hi"),
        )
        for c in columns
        for i, p in enumerate(probs)
    ]
    return df.agg(*stats).select(F.inline(F.array(*cells)))


def _narrowed(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """Brackets again, by steps among the values inside the first ones."""
    inside = (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
    steps = [i / STEPS for i in range(STEPS + 1)]
    told = values.join(F.broadcast(brackets), "feature").groupBy("feature", "prob", "n").agg(
        F.count_if(F.col("value") < F.col("lo")).alias("below"), F.count_if(inside).alias("m"),
        F.percentile_approx(F.when(inside, F.col("value")), steps, ACCURACY).alias("grid"),
    )
    step = F.floor(((F.col("n") - 1) * F.col("prob") - F.col("below")) / F.greatest(F.col("m"), F.lit(1)) * STEPS).cast("int")
    at = lambda i: F.get("grid", F.greatest(F.lit(0), F.least(F.lit(STEPS), i)))
    return told.select("feature", "prob", "n", at(step - AROUND).alias("lo"), at(step + AROUND + 1).alias("hi"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """``(feature, prob, n, quantile)``; NULL where a column holds no number."""
    brackets = _brackets(df, columns, probs)
    named = [F.struct(F.lit(c).alias("feature"), as_double(quoted(c)).alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*named))).where(F.col("value").isNotNull())
    zone = F.when(F.col("value") < F.col("lo"), -1).when(F.col("value") > F.col("hi"), 1).otherwise(0)
    counted = (
        values.join(F.broadcast(_narrowed(values, brackets)), "feature")
        .withColumn("zone", zone)
        .groupBy("feature", "prob", "n", "zone", F.when(F.col("zone") == 0, F.col("value")).alias("inside"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("value"), F.max("value").alias("top"))
    )
    upto = Window.partitionBy("feature", "prob").orderBy("zone", "inside")
    position = (F.col("n") - 1) * F.col("prob")
    lower = F.floor(position) + 1
    upper = F.least(lower + 1, F.col("n"))
    ranked = counted.withColumn("upto", F.sum("rows").over(upto)).withColumn("value", F.when(F.col("zone") < 0, F.col("top")).otherwise(F.col("value")))
    picked = ranked.groupBy("feature", "prob", "n").agg(
        F.min(F.when(F.col("upto") >= lower, F.col("value"))).alias("a"),
        F.min(F.when(F.col("upto") >= upper, F.col("value"))).alias("b"),
    )
    found = picked.withColumn("quantile", F.col("a") + (F.col("b") - F.col("a")) * (position - F.floor(position)))
    return brackets.select("feature", "prob", "n").join(found.select("feature", "prob", "quantile"), ["feature", "prob"], "left")
