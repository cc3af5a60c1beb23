"""Registered queries: fuzzy joins, name resolution, alignment, entity linking.

The right side of the fuzzy join is derived from the left by known changes of
spelling, so the expected partner and score follow from arithmetic in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions.text import fold_plain, search_variants
from kindred.operators import linkage as L
from kindred.plans.registry import query
from kindred.plans.tables import PEOPLE_SQL, people
from kindred.session import shuffled

# Row number modulo 6 decides the change of spelling on the right side:
# 0 none, 1 words swapped, 2 last letter lost, 3 other club, 4 absent, 5 two letters lost in both words.


def respelled(p):
    kind = F.col("row_id") % 6
    name = (
        F.when(kind == 1, F.concat_ws(" ", "last", "first"))
        .when(kind == 2, F.concat_ws(" ", "first", F.substring("last", 1, 11)))
        .when(kind == 5, F.concat_ws(" ", F.substring("first", 1, 8), F.substring("last", 1, 10)))
        .otherwise(F.col("player"))
    )
    club = F.when(kind == 3, F.repeat(F.lit("q"), F.lit(40))).otherwise(F.col("squad"))
    return p.where(kind != 4).select("row_id", name.alias("player"), club.alias("squad"), "market_value_eur")


@query(
    "fuzzy_join_cascade",
    "WITH " + PEOPLE_SQL + """
SELECT row_id, player, CASE WHEN row_id % 6 = 4 THEN 'no_match' WHEN row_id % 6 = 3 THEN 'name_only' ELSE 'full_key' END AS match_strategy,
       CASE row_id % 6 WHEN 4 THEN NULL WHEN 2 THEN round(200.0::DOUBLE * (n - 1) / (2 * n - 1), 6)
                       WHEN 5 THEN round(200.0::DOUBLE * (n - 4) / (2 * n - 4), 6) ELSE 100.0 END AS match_score,
       CASE WHEN row_id % 6 <> 4 THEN market_value_eur END AS market_value_eur
FROM (SELECT *, length(player || ' | ' || squad) AS n FROM people)""",
)
def fuzzy_join_cascade(spark, sf_dir):
    p = people(spark, sf_dir)
    joined = L.fuzzy_join(p.select("row_id", "player", "squad"), respelled(p), 85.0)
    return joined.select("row_id", "player", "match_strategy", F.round("match_score", 6).alias("match_score"), "market_value_eur")


@query(
    "fuzzy_match_coverage",
    "WITH " + PEOPLE_SQL + """
SELECT CASE WHEN row_id % 6 = 4 THEN 'no_match' WHEN row_id % 6 = 3 THEN 'name_only' ELSE 'full_key' END AS match_strategy, count(*) AS n
FROM people GROUP BY ALL""",
)
def fuzzy_match_coverage(spark, sf_dir):
    from kindred.operators.quality import counts_by

    return counts_by(fuzzy_join_cascade(spark, sf_dir), "match_strategy")


# Row number modulo 3 decides the request: 0 full name in capitals, 1 a middle stretch, 2 the last word.


def _requests(p):
    kind = F.col("row_id") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit("  "), F.upper("player"), F.lit(" ")))
        .when(kind == 1, F.substring("player", 4, 12))
        .otherwise(F.col("last"))
    )
    return p.select(F.col("row_id").alias("query_id"), text.alias("query"))


@query(
    "name_resolution",
    "WITH " + PEOPLE_SQL + """,
asked AS (SELECT row_id AS query_id, CASE row_id % 3 WHEN 0 THEN upper(player) WHEN 1 THEN substr(player, 4, 12) ELSE last END AS text FROM people)
SELECT query_id, CASE WHEN query_id % 3 = 0 THEN 'exact' ELSE 'contained' END AS stage, min(row_id) AS row_id, count(*) AS candidates
FROM asked JOIN people ON contains(player, lower(text)) GROUP BY ALL""",
)
def name_resolution(spark, sf_dir):
    p = people(spark, sf_dir)
    found = L.resolve_names(_requests(p), p)
    return found.select("query_id", "stage", "row_id", "candidates")


@query(
    "name_resolution_fuzzy",
    "WITH " + PEOPLE_SQL + " SELECT row_id AS query_id, 'fuzzy_last_name' AS stage, row_id, round(200.0::DOUBLE * 11 / 23, 6) AS score FROM people",
)
def name_resolution_fuzzy(spark, sf_dir):
    """Last words with a letter missing in the middle."""
    p = people(spark, sf_dir)
    typo = F.concat(F.substring("last", 1, 5), F.substring("last", 7, 6))
    found = L.resolve_names(p.select(F.col("row_id").alias("query_id"), typo.alias("query")), p)
    return found.select("query_id", "stage", "row_id", F.round("score", 6).alias("score"))


@query(
    "profile_lookup",
    "WITH " + PEOPLE_SQL + """,
asked AS (SELECT row_id AS query_id, CASE row_id % 3 WHEN 0 THEN upper(player) WHEN 1 THEN substr(player, 4, 12) ELSE last || '#' END AS text FROM people)
SELECT query_id, CASE query_id % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'contained' ELSE 'not_found' END AS status, min(row_id) AS row_id
FROM asked LEFT JOIN people ON contains(player, lower(text)) GROUP BY ALL""",
)
def profile_lookup(spark, sf_dir):
    p = people(spark, sf_dir)
    kind = F.col("row_id") % 3
    text = F.when(kind == 0, F.upper("player")).when(kind == 1, F.substring("player", 4, 12)).otherwise(F.concat("last", F.lit("#")))
    found = L.lookup_profiles(p.select(F.col("row_id").alias("query_id"), text.alias("query")), p)
    return found.select("query_id", "status", "row_id")


@query(
    "benchmark_alignment",
    "WITH " + PEOPLE_SQL + """
SELECT q.player AS query_player, c.player AS similar_player, row_number() OVER (PARTITION BY q.row_id ORDER BY j)::INTEGER AS tm_rank
FROM people q, (VALUES (1), (2)) v(j) JOIN people c ON c.row_id = (q.row_id * 7 + j) % (SELECT count(*) FROM people) WHERE c.row_id <> q.row_id""",
)
def benchmark_alignment(spark, sf_dir):
    """Each person paired with two others, all spelled with a letter missing."""
    p = people(spark, sf_dir)
    n = p.agg(F.count(F.lit(1))).scalar()
    misspelt = p.select("row_id", F.concat(F.substring("player", 1, 6), F.substring("player", 8, 20)).alias("name"))
    pairs = misspelt.select(F.col("name").alias("query"), "row_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("ord"))
    pairs = pairs.withColumn("target", (F.col("row_id") * 7 + F.col("ord")) % n)
    curated = pairs.join(shuffled(misspelt.select(F.col("row_id").alias("target"), F.col("name").alias("similar"))), "target")
    return L.align_benchmark(curated.select("query", "similar", "ord"), p).select("query_player", "similar_player", "tm_rank")


# Row number modulo 4 decides what the candidate service offers: 0 the same name for the
# full spelling, 1 the same last word for the last word, 2 one shared word in three,
# 3 both words among four for the first word.


@query(
    "entity_link_jaccard",
    "WITH " + PEOPLE_SQL + """
SELECT row_id, CASE row_id % 4 WHEN 0 THEN player WHEN 1 THEN 'qx ' || last WHEN 3 THEN last || ' xx ' || first || ' yy' END AS candidate,
       CASE row_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 3 THEN 0.5 END AS score,
       CASE row_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 END AS variant_no FROM people""",
)
def entity_link_jaccard(spark, sf_dir):
    p = people(spark, sf_dir)
    folded = p.withColumn("plain", fold_plain(F.col("player")))
    searches = folded.select("row_id", "plain")
    variants = folded.select(
        "row_id", "first", "last", "player",
        F.posexplode(search_variants(F.col("player"), F.col("plain"))).alias("variant_no", "variant"),
    )
    kind, v = F.col("row_id") % 4, F.col("variant_no")
    offered = (
        F.when((kind == 0) & (v == 0), F.col("player"))
        .when((kind == 1) & (v == 1), F.concat(F.lit("qx "), "last"))
        .when((kind == 2) & (v == 1), F.concat("first", F.lit(" zz qq")))
        .when((kind == 3) & (v == 2), F.concat("last", F.lit(" xx "), "first", F.lit(" yy")))
        .otherwise(F.lit("nobody at all"))
    )
    candidates = variants.select(
        "row_id", "variant_no", F.lit(1).alias("cand_no"), fold_plain(offered).alias("candidate_plain"),
        F.concat(F.lit("http://images.example/"), F.col("row_id").cast("string")).alias("url"),
    )
    return L.link_candidates(searches, candidates).select("row_id", F.col("candidate_plain").alias("candidate"), "score", "variant_no")
