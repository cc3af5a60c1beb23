"""Ranking metrics at several cut-offs, for every query in one plan.

Relevant sets are never materialised: group truth needs only group sizes and
an equi-join on the retrieved rows, curated truth an equi-join on its edges.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.constants import EVALUATION_GROUPS
from kindred.functions.positions import evaluation_group
from kindred.session import cut_lineage, numbered, shuffled

METRICS = ["precision_at_k", "recall_at_k", "ndcg_at_k", "f1_at_k"]


def ideal_gain(n_relevant: Column, k: Column) -> Column:
    """Gain of a perfect list of ``min(n_relevant, k)`` hits; 0 for none."""
    hits = F.least(n_relevant.cast("int"), k.cast("int"))
    terms = F.transform(F.sequence(F.lit(1), hits), lambda r: 1.0 / F.log2(r + 1.0))
    return F.when(hits > 0, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def ranking_metrics(queries: DataFrame, hits: DataFrame, k_values: list[int], keys: list[str]) -> DataFrame:
    """Precision, recall, NDCG and F1 at each k.

    ``queries(keys…, n_relevant, …)`` has one row per evaluated query;
    ``hits(keys…, rank, item)`` holds retrieved rows that are relevant.
    Distinct items count for precision and recall, list positions for NDCG.
    """
    expanded = queries.withColumn("k", F.explode(F.array(*[F.lit(k) for k in k_values])))
    inside = F.col("rank") <= F.col("k")
    counted = (
        hits.withColumn("k", F.explode(F.array(*[F.lit(k) for k in k_values])))
        .where(inside)
        .groupBy(*keys, "k")
        .agg(F.countDistinct("item").alias("_hits"), F.sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("_dcg"))
    )
    n_hits = F.coalesce("_hits", F.lit(0))
    gain = F.coalesce("_dcg", F.lit(0.0))
    ideal = ideal_gain(F.col("n_relevant"), F.col("k"))
    p, r = F.col("precision_at_k"), F.col("recall_at_k")
    return (
        expanded.join(shuffled(counted), [*keys, "k"], "left")
        .withColumn("precision_at_k", F.when(F.col("k") == 0, 0.0).otherwise(n_hits / F.when(F.col("k") != 0, F.col("k"))))
        .withColumn("recall_at_k", F.when(F.col("n_relevant") == 0, 0.0).otherwise(n_hits / F.when(F.col("n_relevant") != 0, F.col("n_relevant"))))
        .withColumn("ndcg_at_k", F.when(ideal == 0, 0.0).otherwise(gain / ideal))
        .withColumn("f1_at_k", F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)))
        .drop("_hits", "_dcg")
    )


def sample_queries(df: DataFrame, n: int, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Seeded sample without replacement: the n smallest keyed digests, a distributed top-n."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


# -------------------------------------------------------- truth 1: position group


def last_row_per_name(profiles: DataFrame) -> DataFrame:
    """Lower-cased name to the last row that carries it."""
    return profiles.groupBy(F.lower("player").alias("name_key")).agg(F.max("row_id").alias("resolved_row_id"))


def position_truth(profiles: DataFrame, rules: list[tuple[str, list[str]]] = EVALUATION_GROUPS) -> tuple[DataFrame, DataFrame]:
    """``grouped(row_id, player, position_group)`` and ``names(position_group, player, copies)``."""
    grouped = profiles.select("row_id", "player", evaluation_group(F.col("pos"), rules).alias("position_group"))
    grouped = grouped.where(F.col("position_group").isNotNull())
    names = grouped.groupBy("position_group", "player").agg(F.count(F.lit(1)).alias("copies"))
    return grouped, names


def position_queries(
    profiles: DataFrame,
    n_queries: int | None = None,
    rules: list[tuple[str, list[str]]] = EVALUATION_GROUPS,
) -> tuple[DataFrame, DataFrame]:
    """Method 1 queries with the size of their relevant set, and the group names.

    Rows of the same evaluation group are relevant, the query row is not.  A
    name stands for the last row that carries it, as in name resolution.
    """
    grouped, names = position_truth(profiles, rules)
    asked = sample_queries(grouped, n_queries) if n_queries else grouped
    sizes = names.groupBy("position_group").agg(F.count(F.lit(1)).alias("n_names"))
    own = names.withColumnRenamed("copies", "own_copies")
    queries = (
        asked.join(shuffled(own), ["position_group", "player"])
        .join(F.broadcast(sizes), "position_group")
        .withColumn("n_relevant", F.col("n_names") - F.when(F.col("own_copies") == 1, 1).otherwise(0))
        .where(F.col("n_relevant") > 0)
        .withColumn("name_key", F.lower("player"))
        .join(shuffled(last_row_per_name(profiles)), "name_key")
        .select(
            F.col("row_id").alias("query_id"), F.col("resolved_row_id").alias("row_id"),
            F.col("player").alias("query_player"), "position_group", "own_copies", "n_relevant",
        )
    )
    return queries, names


def position_hits(retrieved: DataFrame, queries: DataFrame, names: DataFrame) -> DataFrame:
    return (
        retrieved.join(shuffled(queries), "row_id")
        .join(shuffled(names.select("position_group", F.col("player").alias("item"))), ["position_group", "item"], "left_semi")
        .where((F.col("item") != F.col("query_player")) | (F.col("own_copies") > 1))
    )


def curated_queries(edges: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Method 2 queries and truth from ``edges(query_player, similar_player)``.

    Query names are matched without case; a name of no profile is skipped.
    """
    truth = edges.select(F.lower("query_player").alias("name_key"), F.col("similar_player").alias("item")).distinct()
    sizes = truth.groupBy("name_key").agg(F.count(F.lit(1)).alias("n_relevant"))
    queries = (
        numbered(edges.select("query_player").distinct(), "query_id")
        .withColumn("name_key", F.lower("query_player"))
        .join(shuffled(sizes), "name_key")
        .join(shuffled(last_row_per_name(profiles)), "name_key")
        .select(
            "query_id", F.col("resolved_row_id").alias("row_id"), "query_player", "name_key", "n_relevant",
        )
    )
    return queries, truth


def curated_hits(retrieved: DataFrame, queries: DataFrame, truth: DataFrame) -> DataFrame:
    return retrieved.join(shuffled(queries), "row_id").join(shuffled(truth), ["name_key", "item"], "left_semi")


def evaluate(
    profiles: DataFrame,
    retrievers: dict | Callable,
    k_values: list[int],
    n_queries: int | None = None,
    edges: DataFrame | None = None,
    by_position: bool = True,
    rules: list[tuple[str, list[str]]] = EVALUATION_GROUPS,
) -> DataFrame:
    """Evaluation records of every variant under one or both methods.

    ``retrievers`` maps a variant label to ``retrieve(queries(query_id,
    row_id), k)`` giving ``query_id, rank, player``; or it is one search for all
    (``retrieval.Variants``), with its ``labels``.  Each variant is searched once
    for the queries of all methods and all k together.
    """
    methods = []
    if by_position:
        methods.append(("position_based", *position_queries(profiles, n_queries, rules), position_hits))
    if edges is not None:
        methods.append(("curated_benchmark", *curated_queries(edges, profiles), curated_hits))
    rows = reduce(DataFrame.unionByName, [q.select("row_id") for _, q, _, _ in methods]).distinct()
    asked = cut_lineage(rows.select(F.col("row_id").alias("query_id"), "row_id"))
    if callable(retrievers):
        variants, found = retrievers.labels, retrievers(asked, max(k_values))
    else:
        searches = [retrieve(asked, max(k_values)).withColumn("embedding_type", F.lit(label)) for label, retrieve in retrievers.items()]
        variants, found = list(retrievers), reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), searches)
    retrieved = cut_lineage(found.select("embedding_type", F.col("query_id").alias("row_id"), "rank", F.col("player").alias("item")))
    keys = ["embedding_type", "query_id"]
    labels = F.explode(F.array(*[F.lit(label) for label in variants]))
    frames = []
    for name, queries, truth, find_hits in methods:
        hits = find_hits(retrieved, queries, truth).select(*keys, "rank", "item")
        listed = [c for c in ["query_player", "position_group", "n_relevant"] if c in queries.columns]
        per_label = queries.select("query_id", *listed).withColumn("embedding_type", labels)
        frames.append(ranking_metrics(per_label, hits, k_values, keys).withColumn("eval_method", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# -------------------------------------------------------------------- summaries


def summarise(results: DataFrame, *keys: str) -> DataFrame:
    return results.groupBy(*keys).agg(*[F.bround(F.avg(m), 4).alias(m) for m in METRICS])


def summarise_levels(results: DataFrame) -> DataFrame:
    """All reported levels at once: (type, method, k), (type, k) and (k)."""
    levels = [
        [F.col("embedding_type"), F.col("eval_method"), F.col("k")],
        [F.col("embedding_type"), F.col("k")],
        [F.col("k")],
    ]
    return results.groupingSets(levels, "embedding_type", "eval_method", "k").agg(
        F.count(F.lit(1)).alias("n"), *[F.bround(F.avg(m), 4).alias(m) for m in METRICS]
    )

