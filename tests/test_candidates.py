"""Entity candidates: joins on derived rows never pass through the driver."""

from kindred.operators import linkage


def test_candidate_joins_are_not_broadcast(spark):
    searches = spark.createDataFrame([(1, "jude bellingham"), (2, "kane")], "row_id long, plain string")
    offered = spark.createDataFrame(
        [(1, 0, 1, "nobody", "http://a"), (1, 1, 1, "jude bellingham", "http://b"), (2, 0, 7, "kane", "http://c")],
        "row_id long, variant_no int, cand_no int, candidate_plain string, url string",
    )
    linked = linkage.link_candidates(searches, offered)
    assert "BroadcastHashJoin" not in linked._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["row_id"], r["url"]) for r in linked.collect()) == [(1, "http://b"), (2, None)]
