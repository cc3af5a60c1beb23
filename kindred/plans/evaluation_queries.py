"""Registered queries: retrieval quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import metrics as M
from kindred.operators import retrieval as R
from kindred.plans.registry import query
from kindred.plans.tables import BLOCK_PROFILES_SQL, PROFILES_SQL, block_profiles, profiles
from kindred.session import shuffled

KS = [3, 5, 10]

_GROUP_SQL = """CASE WHEN pos LIKE '%CF%' OR pos LIKE '%ST%' OR pos LIKE '%SS%' OR pos LIKE '%FW%' THEN 'Striker'
  WHEN pos LIKE '%LW%' OR pos LIKE '%RW%' THEN 'Winger' WHEN pos LIKE '%AM%' THEN 'CAM' WHEN pos LIKE '%CM%' THEN 'CM'
  WHEN pos LIKE '%DM%' THEN 'CDM' WHEN pos LIKE '%LB%' OR pos LIKE '%RB%' OR pos LIKE '%LWB%' OR pos LIKE '%RWB%' THEN 'FB'
  WHEN pos LIKE '%CB%' THEN 'CB' WHEN pos LIKE '%GK%' THEN 'GK' END"""

# Expects relations retrieved(variant, query_id, rank, item), truth(query_id, item) and asked(query_id, …, n_relevant).
_METRIC_SQL = """measured AS (
  SELECT a.*, k, coalesce(h.hits, 0) / k::DOUBLE AS precision_at_k, coalesce(h.hits, 0) / n_relevant::DOUBLE AS recall_at_k,
         coalesce(h.dcg, 0.0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(n_relevant, k) + 1) r(i)) AS ndcg_at_k
  FROM (SELECT * FROM asked, (VALUES (3), (5), (10)) v(k)) a
  LEFT JOIN (SELECT r.{keys_r}, k, count(DISTINCT r.item) AS hits, sum(1 / log2(r.rank + 1)) AS dcg
             FROM retrieved r JOIN truth t ON t.query_id = r.query_id AND t.item = r.item, (VALUES (3), (5), (10)) v(k)
             WHERE r.rank <= k GROUP BY ALL) h USING ({keys}, k)),
metrics AS (
  SELECT *, CASE WHEN precision_at_k + recall_at_k = 0 THEN 0.0
                 ELSE 2 * precision_at_k * recall_at_k / (precision_at_k + recall_at_k) END AS f1_at_k FROM measured)"""


def _retriever(p, weights):
    return lambda asked, k: R.find_similar(p, asked, weights, k=k, columns=["player"])


def _rounded(df, *keys):
    return df.select(*keys, *[F.round(m, 6).alias(m) for m in M.METRICS])


_POSITION_SQL = (
    "WITH " + PROFILES_SQL + """,
retrieved AS (
  SELECT query_id, item, rank FROM (
    SELECT q.row_id AS query_id, c.player AS item,
           row_number() OVER (PARTITION BY q.row_id ORDER BY round(list_cosine_similarity(q.vec, c.vec), 12) DESC, c.row_id) AS rank
    FROM profiles q JOIN profiles c ON q.row_id <> c.row_id) WHERE rank <= 10),
grouped AS (SELECT row_id, player, """ + _GROUP_SQL + """ AS position_group FROM profiles),
truth AS (SELECT a.row_id AS query_id, b.player AS item FROM grouped a JOIN grouped b USING (position_group) WHERE a.row_id <> b.row_id),
asked AS (SELECT t.query_id, g.player AS query_player, g.position_group, count(DISTINCT t.item) AS n_relevant
          FROM truth t JOIN grouped g ON g.row_id = t.query_id GROUP BY ALL),
""" + _METRIC_SQL.format(keys="query_id", keys_r="query_id")
)


@query(
    "eval_position_based",
    _POSITION_SQL + """
SELECT query_player, position_group, k, n_relevant, round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k,
       round(ndcg_at_k, 6) AS ndcg_at_k, round(f1_at_k, 6) AS f1_at_k FROM metrics""",
)
def eval_position_based(spark, sf_dir):
    p = profiles(spark, sf_dir)
    found = M.evaluate(p, {"hybrid": _retriever(p, {"vec": 1.0})}, KS)
    return _rounded(found, "query_player", "position_group", "k", "n_relevant")


@query(
    "eval_position_summary",
    _POSITION_SQL + """
SELECT position_group, k, round_even(avg(precision_at_k), 4) AS precision_at_k, round_even(avg(recall_at_k), 4) AS recall_at_k,
       round_even(avg(ndcg_at_k), 4) AS ndcg_at_k, round_even(avg(f1_at_k), 4) AS f1_at_k FROM metrics GROUP BY ALL""",
)
def eval_position_summary(spark, sf_dir):
    p = profiles(spark, sf_dir)
    return M.summarise(M.evaluate(p, {"hybrid": _retriever(p, {"vec": 1.0})}, KS), "position_group", "k")


def _edges(p):
    """Three curated neighbours per profile, named by arithmetic on the row number."""
    n = p.agg(F.count(F.lit(1)).alias("n"))
    targets = p.select("row_id", F.col("player").alias("query_player"), F.explode(F.array(*[F.lit(j) for j in (1, 2, 3)])).alias("tm_rank"))
    targets = targets.withColumn("target", (F.col("row_id") * 7 + F.col("tm_rank")) % n.scalar())
    named = p.select(F.col("row_id").alias("target"), F.col("player").alias("similar_player"))
    return targets.join(shuffled(named), "target").where(F.col("target") != F.col("row_id")).select("query_player", "similar_player", "tm_rank")


_EDGES_SQL = """edges AS (
  SELECT q.row_id AS query_id, q.player AS query_player, c.player AS similar_player
  FROM profiles q, (VALUES (1), (2), (3)) v(j) JOIN profiles c ON c.row_id = (q.row_id * 7 + j) % (SELECT count(*) FROM profiles)
  WHERE c.row_id <> q.row_id)"""


@query(
    "eval_curated",
    "WITH " + PROFILES_SQL + ", " + _EDGES_SQL + """,
retrieved AS (
  SELECT query_id, item, rank FROM (
    SELECT q.row_id AS query_id, c.player AS item,
           row_number() OVER (PARTITION BY q.row_id ORDER BY round(list_cosine_similarity(q.vec, c.vec), 12) DESC, c.row_id) AS rank
    FROM profiles q JOIN profiles c ON q.row_id <> c.row_id) WHERE rank <= 10),
truth AS (SELECT DISTINCT query_id, similar_player AS item FROM edges),
asked AS (SELECT query_id, query_player, count(DISTINCT similar_player) AS n_relevant FROM edges GROUP BY ALL),
""" + _METRIC_SQL.format(keys="query_id", keys_r="query_id") + """
SELECT query_player, k, n_relevant, round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k,
       round(ndcg_at_k, 6) AS ndcg_at_k, round(f1_at_k, 6) AS f1_at_k FROM metrics""",
)
def eval_curated(spark, sf_dir):
    p = profiles(spark, sf_dir)
    found = M.evaluate(p, {"hybrid": _retriever(p, {"vec": 1.0})}, KS, edges=_edges(p), by_position=False)
    return _rounded(found, "query_player", "k", "n_relevant")


@query(
    "eval_comparison_grouping_sets",
    "WITH " + BLOCK_PROFILES_SQL + ", " + _EDGES_SQL + """,
variants(variant, a) AS (VALUES ('stat', 1.0::DOUBLE), ('text', 0.0::DOUBLE), ('hybrid', 0.6::DOUBLE)),
scored AS (
  SELECT variant, q.row_id AS query_id, c.row_id, c.player AS item,
         round((a * a * list_dot_product(q.stat, c.stat) + (1 - a) * (1 - a) * list_dot_product(q.text, c.text)) / (a * a + (1 - a) * (1 - a)), 12) AS score
  FROM variants, units q JOIN units c ON q.row_id <> c.row_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY variant, query_id ORDER BY score DESC, row_id) AS rank FROM scored),
grouped AS (SELECT row_id, player, """ + _GROUP_SQL + """ AS position_group FROM profiles),
pos_truth AS (SELECT a.row_id AS query_id, b.player AS item FROM grouped a JOIN grouped b USING (position_group) WHERE a.row_id <> b.row_id),
truth AS (SELECT 'position_based' AS eval_method, * FROM pos_truth
          UNION ALL SELECT DISTINCT 'curated_benchmark', query_id, similar_player FROM edges),
asked AS (SELECT eval_method, query_id, count(DISTINCT item) AS n_relevant FROM truth GROUP BY ALL),
measured AS (
  SELECT a.variant, a.eval_method, a.k, coalesce(h.hits, 0) / a.k::DOUBLE AS p, coalesce(h.hits, 0) / n_relevant::DOUBLE AS r,
         coalesce(h.dcg, 0.0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(n_relevant, a.k) + 1) x(i)) AS n
  FROM (SELECT * FROM asked, (SELECT variant FROM variants), (VALUES (3), (5), (10)) v(k)) a
  LEFT JOIN (SELECT variant, eval_method, r.query_id, k, count(DISTINCT r.item) AS hits, sum(1 / log2(rank + 1)) AS dcg
             FROM ranked r JOIN truth t ON t.query_id = r.query_id AND t.item = r.item, (VALUES (3), (5), (10)) v(k)
             WHERE rank <= k GROUP BY ALL) h USING (variant, eval_method, query_id, k))
SELECT variant AS embedding_type, eval_method, k, count(*) AS n, round_even(avg(p), 4) AS precision_at_k, round_even(avg(r), 4) AS recall_at_k,
       round_even(avg(n), 4) AS ndcg_at_k, round_even(avg(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END), 4) AS f1_at_k
FROM measured GROUP BY GROUPING SETS ((variant, eval_method, k), (variant, k), (k))""",
)
def eval_comparison_grouping_sets(spark, sf_dir):
    from kindred.operators.features import unit_blocks

    p = unit_blocks(block_profiles(spark, sf_dir), ["stat", "text"])
    variants = R.Variants(p, {"stat": {"stat": 1.0}, "text": {"text": 1.0}, "hybrid": R.stat_text_weights(0.6)})
    return M.summarise_levels(M.evaluate(p, variants, KS, edges=_edges(p)))


@query(
    "query_sample_seeded",
    "WITH " + PROFILES_SQL + """,
grouped AS (SELECT row_id, vec, """ + _GROUP_SQL + """ AS position_group FROM profiles),
asked AS (SELECT * FROM grouped WHERE position_group IS NOT NULL ORDER BY md5('42:' || row_id), row_id LIMIT 100),
scored AS (
  SELECT q.row_id AS query_id, position_group, c.row_id, c.player, list_cosine_similarity(q.vec, c.vec) AS similarity,
         row_number() OVER (PARTITION BY q.row_id ORDER BY round(list_cosine_similarity(q.vec, c.vec), 12) DESC, c.row_id) AS rank
  FROM asked q JOIN profiles c ON q.row_id <> c.row_id)
SELECT query_id, position_group, rank, row_id, player, round_even(similarity, 4) AS similarity FROM scored WHERE rank <= 5""",
)
def query_sample_seeded(spark, sf_dir):
    p = profiles(spark, sf_dir)
    grouped, _ = M.position_truth(p)
    asked = M.sample_queries(grouped, 100).select(F.col("row_id").alias("query_id"), "row_id", "position_group")
    found = R.find_similar(p, asked.select("query_id", "row_id"), {"vec": 1.0}, k=5, columns=["player"])
    return found.join(asked.select("query_id", "position_group"), "query_id").select(
        "query_id", "position_group", "rank", "row_id", "player", "similarity"
    )
