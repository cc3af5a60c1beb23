"""Coverage of the fuzzy join over names that all go through its last step."""

import random

from kindred.operators import linkage
from kindred.operators.quality import counts_by


def test_coverage_of_alike_names(spark):
    """Every left row is counted once, and the last step never joins pairs of blocks."""
    rng = random.Random(8)
    word = lambda k: "".join(rng.choice("etaoinshrdlucmfw") for _ in range(k))
    names = [(i, f"{word(10)} {word(12)}", f"Brand#{rng.randint(1, 25)}") for i in range(300)]
    spoilt = [(i, n[:8] + n[10:20], s) if i % 3 == 0 else (i, word(9) + " " + word(11), s) for i, n, s in names]
    left = spark.createDataFrame(names, "row_id long, player string, squad string")
    right = spark.createDataFrame(spoilt, "row_id long, player string, squad string")
    texts = left.selectExpr("row_id", "player AS text")
    far = linkage.best_fuzzy(texts.withColumnRenamed("row_id", "query_id"), texts, 85.0, linkage.IndelKernel)
    assert "Join" not in far._jdf.queryExecution().executedPlan().toString()
    joined = linkage.fuzzy_join(left, right, 85.0, [])
    found = {r["match_strategy"]: r["n"] for r in counts_by(joined, "match_strategy").collect()}
    assert found == {"full_key": 100, "no_match": 200}
