"""Registered queries: retrieval modes and re-ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions.positions import broad_group
from kindred.functions.text import bar_band, similarity_band
from kindred.functions.vectors import blend, cosine
from kindred.operators import retrieval as R
from kindred.plans.registry import query
from kindred.plans.tables import BLOCK_PROFILES_SQL, PROFILES_SQL, block_profiles, profiles

VEC = {"vec": 1.0}
ALPHA = 0.6

_SCORED = """scored AS (
  SELECT q.row_id AS query_id, c.row_id, c.player, c.pos, c.market_value_eur,
         round(list_cosine_similarity(q.vec, c.vec), 12) AS score
  FROM profiles q JOIN profiles c ON {on}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)::INTEGER AS rank FROM scored {where})
SELECT query_id, rank, row_id, player, round_even(score, 4) AS similarity FROM ranked WHERE rank <= {k}"""

RESULT = ["query_id", "rank", "row_id", "player", "similarity"]


def _self_queries(p):
    return p.select(F.col("row_id").alias("query_id"), "row_id")


@query("similar_topk", "WITH " + PROFILES_SQL + ", " + _SCORED.format(on="q.row_id <> c.row_id", where="", k=10))
def similar_topk(spark, sf_dir):
    p = profiles(spark, sf_dir)
    return R.find_similar(p, _self_queries(p), VEC, k=10, columns=["player"]).select(*RESULT)


@query("similar_topk_cells", "WITH " + PROFILES_SQL + ", " + _SCORED.format(on="q.row_id <> c.row_id", where="", k=10))
def similar_topk_cells(spark, sf_dir):
    """The rows of ``similar_topk`` by pivots and rings."""
    p = profiles(spark, sf_dir)
    return R.find_similar(p, _self_queries(p), VEC, k=10, columns=["player"], method="cells").select(*RESULT)


@query(
    "similar_topk_position",
    "WITH " + PROFILES_SQL + ", " + _SCORED.format(on="q.row_id <> c.row_id AND upper(c.pos) LIKE '%LW%'", where="", k=10),
)
def similar_topk_position(spark, sf_dir):
    p = profiles(spark, sf_dir)
    return R.find_similar(p, _self_queries(p), VEC, k=10, position_filter="lw", columns=["player"]).select(*RESULT)


_BROAD_SQL = """CASE WHEN {p} LIKE '%GK%' THEN 'GK'
  WHEN {p} LIKE '%CB%' OR {p} LIKE '%LB%' OR {p} LIKE '%RB%' OR {p} LIKE '%WB%' THEN 'DEF'
  WHEN {p} LIKE '%DM%' OR {p} LIKE '%CM%' OR {p} LIKE '%AM%' OR {p} LIKE '%LM%' OR {p} LIKE '%RM%' THEN 'MID'
  WHEN {p} LIKE '%LW%' OR {p} LIKE '%RW%' OR {p} LIKE '%CF%' OR {p} LIKE '%ST%' OR {p} LIKE '%SS%' OR {p} LIKE '%FW%' THEN 'FWD'
  ELSE 'UNK' END"""


@query(
    "budget_replacement",
    "WITH " + PROFILES_SQL + ", " + _SCORED.format(
        on="q.row_id <> c.row_id AND coalesce(c.market_value_eur <= coalesce(q.market_value_eur, 920.0), true) AND "
        + _BROAD_SQL.format(p="q.pos") + " = " + _BROAD_SQL.format(p="c.pos"),
        where="", k=5),
)
def budget_replacement(spark, sf_dir):
    p = profiles(spark, sf_dir)
    asked = p.select(
        F.col("row_id").alias("query_id"), "row_id", F.coalesce("market_value_eur", F.lit(920.0)).alias("budget")
    )
    return R.find_budget_replacement(p, asked, VEC, k=5, columns=["player"]).select(*RESULT)


@query(
    "hidden_gems_reference",
    "WITH " + PROFILES_SQL + ", " + _SCORED.format(
        on="q.row_id <> c.row_id AND c.pos LIKE '%' || q.pos || '%' AND c.market_value_eur <= coalesce(q.market_value_eur, 920.0)",
        where="WHERE score >= 0.1", k=5),
)
def hidden_gems_reference(spark, sf_dir):
    p = profiles(spark, sf_dir)
    targets = p.select(
        F.col("row_id").alias("query_id"), "row_id", F.col("pos").alias("position"),
        F.coalesce("market_value_eur", F.lit(920.0)).alias("max_value"),
    )
    return R.find_hidden_gems(p, targets, VEC, min_similarity=0.1, k=5, columns=["player"]).select(*RESULT)


@query(
    "hidden_gems_centroid",
    "WITH " + PROFILES_SQL + """,
targets AS (SELECT min(row_id) AS query_id, pos AS position, max(market_value_eur) AS max_value FROM profiles GROUP BY pos),
dims AS (SELECT t.position, i, avg(p.vec[i]) AS v
         FROM targets t JOIN profiles p ON p.pos LIKE '%' || t.position || '%', range(1, 65) r(i) GROUP BY ALL),
centroid AS (SELECT position, list(v ORDER BY i) AS vec FROM dims GROUP BY position),
scored AS (
  SELECT t.query_id, c.row_id, c.player, round(list_cosine_similarity(m.vec, c.vec), 12) AS score
  FROM targets t JOIN centroid m USING (position)
  JOIN profiles c ON c.pos LIKE '%' || t.position || '%' AND c.market_value_eur <= t.max_value),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)::INTEGER AS rank
           FROM scored WHERE score >= 0.05)
SELECT query_id, rank, row_id, player, round_even(score, 4) AS similarity FROM ranked WHERE rank <= 5""",
)
def hidden_gems_centroid(spark, sf_dir):
    p = profiles(spark, sf_dir)
    targets = p.groupBy(F.col("pos").alias("position")).agg(
        F.min("row_id").alias("query_id"), F.max("market_value_eur").alias("max_value")
    )
    return R.find_hidden_gems(p, targets, VEC, min_similarity=0.05, k=5, columns=["player"]).select(*RESULT)


@query(
    "hybrid_blocks_alpha",
    "WITH " + BLOCK_PROFILES_SQL + f""",
hybrid AS (SELECT row_id, player, list_concat(list_transform(stat, lambda x: x * {ALPHA}::DOUBLE),
                                              list_transform(text, lambda x: x * (1.0::DOUBLE - {ALPHA}::DOUBLE))) AS vec FROM units),
scored AS (SELECT q.row_id AS query_id, c.row_id, c.player, round(list_cosine_similarity(q.vec, c.vec), 12) AS score
           FROM hybrid q JOIN hybrid c ON q.row_id <> c.row_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, row_id, player, round_even(score, 4) AS similarity FROM ranked WHERE rank <= 10""",
)
def hybrid_blocks_alpha(spark, sf_dir):
    from kindred.operators.features import unit_blocks

    p = unit_blocks(block_profiles(spark, sf_dir), ["stat", "text"])
    return R.find_similar(p, _self_queries(p), R.stat_text_weights(ALPHA), k=10, columns=["player"]).select(*RESULT)


@query(
    "hybrid_vectors",
    "WITH " + BLOCK_PROFILES_SQL + f"""
SELECT row_id, i::INTEGER AS dim, round(v[i], 8) AS value
FROM (SELECT row_id, list_concat(list_transform(stat, lambda x: x * {ALPHA}::DOUBLE),
                                 list_transform(text, lambda x: x * (1.0::DOUBLE - {ALPHA}::DOUBLE))) AS v FROM units), range(1, 65) r(i)""",
)
def hybrid_vectors(spark, sf_dir):
    p = block_profiles(spark, sf_dir).select("row_id", blend(F.col("stat"), F.col("text"), ALPHA).alias("v"))
    return p.select("row_id", F.posexplode("v").alias("d", "x")).select(
        "row_id", (F.col("d") + 1).alias("dim"), F.round("x", 8).alias("value")
    )


@query(
    "blend_rerank",
    "WITH " + BLOCK_PROFILES_SQL + """,
scored AS (SELECT q.row_id AS query_id, c.row_id, c.player, c.is_world_cup, c.market_value_eur,
                  round(list_cosine_similarity(q.stat, c.stat), 12) AS score,
                  list_cosine_similarity(q.text, c.text) AS text_score
           FROM halves q JOIN halves c ON q.row_id <> c.row_id),
cut AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, row_id) AS rk FROM scored),
mixed AS (SELECT *, round_even(0.6::DOUBLE * round_even(score, 4) + (1.0::DOUBLE - 0.6::DOUBLE) * text_score, 4) AS similarity FROM cut WHERE rk <= 25),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, row_id)::INTEGER AS rank FROM mixed),
shown AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM ranked WHERE is_world_cup = 1)
SELECT query_id, rank, row_id, player, similarity,
       CASE WHEN similarity >= 0.82 THEN 'high' WHEN similarity >= 0.65 THEN 'medium' ELSE 'low' END AS band,
       CASE WHEN similarity > 0.8 THEN 'high' WHEN similarity > 0.6 THEN 'medium' ELSE 'low' END AS bar,
       coalesce(market_value_eur, 0.0) / 1e6 AS value_millions
FROM shown WHERE n <= 5""",
)
def blend_rerank(spark, sf_dir):
    p = block_profiles(spark, sf_dir)
    asked = _self_queries(p)
    cut = R.find_similar(p, asked, {"stat": 1.0}, k=25, columns=["player", "is_world_cup", "market_value_eur"])
    described = R.with_query_profile(asked, p, ["text"])
    scores = R.pair_scores(cut.select("query_id", "row_id"), described, p, "text", cosine(F.col("q_vec"), F.col("c_vec")))
    shown = R.first_shown(R.blend_rerank(cut, scores), F.col("is_world_cup") == 1, 5)
    return R.chart_rows(shown, 10).select(
        *RESULT, similarity_band(F.col("similarity")).alias("band"), bar_band(F.col("similarity")).alias("bar"), "value_millions"
    )


@query(
    "position_groups",
    "WITH " + PROFILES_SQL + f"""
SELECT league, {_BROAD_SQL.format(p="pos")} AS broad, count(*) AS n,
       count(*) FILTER (WHERE market_value_eur <= 950) AS under_cap,
       count(*) FILTER (WHERE coalesce(market_value_eur <= 950, true)) AS within_budget
FROM profiles GROUP BY ALL""",
)
def position_groups(spark, sf_dir):
    value = F.col("market_value_eur")
    return profiles(spark, sf_dir).groupBy("league", broad_group(F.col("pos")).alias("broad")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(value <= 950).alias("under_cap"),
        F.count_if(F.coalesce(value <= 950, F.lit(True))).alias("within_budget"),
    )


@query(
    "sorted_listing",
    "WITH " + PROFILES_SQL + " SELECT DISTINCT player, squad, league FROM profiles ORDER BY player, squad, league",
)
def sorted_listing(spark, sf_dir):
    return profiles(spark, sf_dir).select("player", "squad", "league").distinct().orderBy("player", "squad", "league")
