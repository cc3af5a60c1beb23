"""Registered queries: cleaning, quality, exploratory statistics, features, radar, squads."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions.text import profile_sentence
from kindred.operators import features as E
from kindred.operators import quality as Q
from kindred.operators.radar import radar_profiles
from kindred.operators.squads import append_squads
from kindred.plans.registry import query
from kindred.plans.tables import PART_STATS_SQL, PROFILES_SQL, part_stats, profiles, table
from kindred.session import cut_lineage

# ------------------------------------------------------------------- cleaning

_USER_STATS_SQL = """SELECT user_id, count(DISTINCT date_trunc('hour', ts)) * 60 AS minutes,
  count(*) FILTER (WHERE event_type = 'click') AS gls, count(*) FILTER (WHERE event_type = 'view') AS ast,
  count(*) FILTER (WHERE event_type = 'purchase') AS sh FROM events GROUP BY user_id"""


@query(
    "per90_rates",
    f"""SELECT user_id, minutes::DOUBLE AS minutes, gls::DOUBLE AS gls, ast::DOUBLE AS ast, sh::DOUBLE AS sh,
        round_even(gls / (minutes / 90.0::DOUBLE), 4) AS gls_per90, round_even(ast / (minutes / 90.0::DOUBLE), 4) AS ast_per90,
        round_even(sh / (minutes / 90.0::DOUBLE), 4) AS sh_per90
    FROM ({_USER_STATS_SQL}) WHERE minutes >= 450""",
)
def per90_rates(spark, sf_dir):
    kind = F.col("event_type")
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(
        (F.countDistinct(F.date_trunc("hour", "ts")) * 60).alias("minutes"),
        F.count_if(kind == "click").alias("gls"),
        F.count_if(kind == "view").alias("ast"),
        F.count_if(kind == "purchase").alias("sh"),
    )
    return Q.per90_rates(Q.minimum_exposure(users, "minutes"), "minutes")


@query(
    "transfer_dedup",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1""",
)
def transfer_dedup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return Q.keep_max(orders, ["o_custkey"], "o_totalprice", "o_orderkey")


@query(
    "keep_first_dedup",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1""",
)
def keep_first_dedup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return Q.keep_first(orders, ["o_custkey"], "o_orderkey")


# -------------------------------------------------------------------- quality

_CHECKED = ["player", "pos", "age", "market_value_eur", "is_world_cup"]


@query(
    "quality_missing_rates",
    "WITH " + PROFILES_SQL + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 100.0::DOUBLE ELSE 0.0 END), 6) AS missing_pct, "
        f"round(avg(CASE WHEN {c} IS NULL THEN 0.0::DOUBLE ELSE 100.0 END), 6) AS coverage_pct FROM profiles" for c in _CHECKED),
)
def quality_missing_rates(spark, sf_dir):
    p = profiles(spark, sf_dir).select(*_CHECKED)
    both = Q.missing_rates(p).join(Q.coverage(p, _CHECKED), "column_name")
    return both.select("column_name", F.round("missing_pct", 6).alias("missing_pct"), F.round("coverage_pct", 6).alias("coverage_pct"))


@query(
    "quality_duplicates",
    """WITH named AS (SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN p_name END AS p_name, p_brand FROM part)
       SELECT p_partkey, p_name, p_brand FROM (SELECT *, count(*) OVER (PARTITION BY p_name, p_brand) AS n FROM named) WHERE n > 1""",
)
def quality_duplicates(spark, sf_dir):
    """Rows that share name and brand; a missing name equals another missing one."""
    named = F.when(F.col("p_size") % 9 != 0, F.col("p_name")).alias("p_name")
    return Q.duplicate_rows(table(spark, sf_dir, "part").select("p_partkey", named, "p_brand"), ["p_name", "p_brand"])


_LIMITS = {"l_quantity": (5, 45), "l_discount": (0, 0.08), "l_extendedprice": (1000, 90000), "l_tax": (0.01, 1)}


@query(
    "quality_bounds",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}::DOUBLE) AS violations FROM lineitem"
        for c, (lo, hi) in _LIMITS.items()),
)
def quality_bounds(spark, sf_dir):
    return Q.bounds_violations(table(spark, sf_dir, "lineitem"), _LIMITS)


@query(
    "quality_iqr",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence,
            round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence,
            (SELECT count(*) FROM {t} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})"""
        for t, c in [("(SELECT o_totalprice FROM orders)", "o_totalprice"),
                     ("(SELECT o_totalprice * o_totalprice AS price_squared FROM orders)", "price_squared")]),
)
def quality_iqr(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_totalprice", (F.col("o_totalprice") * F.col("o_totalprice")).alias("price_squared"))
    found = Q.iqr_outliers(o, ["o_totalprice", "price_squared"])
    return found.select("feature", *[F.round(c, 6).alias(c) for c in ["q1", "q3", "lower_fence", "upper_fence"]], "outliers")


# ----------------------------------------------------------------- exploratory

_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "eda_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 8) AS corr FROM lineitem" for a in _NUMERIC for b in _NUMERIC),
)
def eda_correlation(spark, sf_dir):
    return Q.correlation_matrix(table(spark, sf_dir, "lineitem"), _NUMERIC).withColumn("corr", F.round("corr", 8))


@query(
    "eda_ols_by_group",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 8) AS r2, count(*) AS n
       FROM lineitem GROUP BY l_returnflag""",
)
def eda_ols_by_group(spark, sf_dir):
    found = Q.ols_by_group(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity")
    return found.select(
        "l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 8).alias("r2"), "n"
    )


@query("eda_counts_cross", "SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL")
def eda_counts_cross(spark, sf_dir):
    return Q.counts_by(table(spark, sf_dir, "part"), "p_type", "p_brand")


@query(
    "eda_value_hist",
    """WITH logs AS (SELECT o_orderpriority, log10(o_totalprice) AS lg FROM orders WHERE o_totalprice > 0),
       edges AS (SELECT min(lg) AS lo, max(lg) AS hi FROM logs)
       SELECT o_orderpriority, least(floor((lg - lo) / ((hi - lo) / 50)), 49)::INTEGER AS bin, count(*) AS n FROM logs, edges GROUP BY ALL""",
)
def eda_value_hist(spark, sf_dir):
    return Q.log_histogram(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderpriority")


@query(
    "eda_distinct_counts",
    "SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS n_distinct FROM orders "
    "UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders "
    "UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders",
)
def eda_distinct_counts(spark, sf_dir):
    return Q.distinct_counts(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority", "o_orderstatus"])


# -------------------------------------------------------------------- features

_FEATURES = ["gls_per90", "ast_per90", "prog_carries_per90", "pass_completion_pct", "blocks_per90"]
_FEATURE_SQL = {f: ("0.0::DOUBLE" if f == "blocks_per90" else f) for f in _FEATURES}


@query(
    "standardise_features",
    "WITH " + PART_STATS_SQL + ", m AS (SELECT " + ", ".join(
        f"avg({e}) AS m{i}, CASE WHEN stddev_pop({e}) = 0 THEN 1.0 ELSE stddev_pop({e}) END AS s{i}" for i, e in enumerate(_FEATURE_SQL.values()))
    + " FROM part_stats) " + " UNION ALL ".join(
        f"SELECT row_id, '{f}' AS feature, round(({e} - m{i}) / s{i}, 6) + 0.0 AS value FROM part_stats, m" for i, (f, e) in enumerate(_FEATURE_SQL.items())),
)
def standardise_features(spark, sf_dir):
    s = part_stats(spark, sf_dir)
    scaled = E.standardise(s, E.feature_moments(s, _FEATURES), _FEATURES)
    names = F.array(*[F.lit(f) for f in _FEATURES])
    return scaled.select("row_id", F.posexplode("scaled").alias("i", "v")).select(
        "row_id", F.element_at(names, F.col("i") + 1).alias("feature"), (F.round("v", 6) + 0.0).alias("value")
    )


@query(
    "pca_features",
    "WITH " + PART_STATS_SQL + ", m AS (SELECT " + ", ".join(
        f"avg({e}) AS m{i}, CASE WHEN stddev_pop({e}) = 0 THEN 1.0 ELSE stddev_pop({e}) END AS s{i}" for i, e in enumerate(_FEATURE_SQL.values()))
    + " FROM part_stats) SELECT row_id, round(sqrt(" + " + ".join(
        f"pow(({e} - m{i}) / s{i}, 2)" for i, e in enumerate(_FEATURE_SQL.values())) + "), 6) AS length FROM part_stats, m",
)
def pca_features(spark, sf_dir):
    """Length of each full-rank component vector, which PCA must preserve."""
    from kindred.functions.vectors import norm

    s = cut_lineage(part_stats(spark, sf_dir))  # read by every step below
    scaled = E.standardise(s, E.feature_moments(s, _FEATURES), _FEATURES)
    reduced = E.apply_pca(scaled, E.fit_pca(scaled, 32, len(_FEATURES)))
    return reduced.select("row_id", F.round(norm(F.col("stat")), 6).alias("length"))


@query(
    "build_embeddings",
    "WITH " + PART_STATS_SQL + """ SELECT row_id, player, 8::INTEGER AS stat_dims, 384::INTEGER AS text_dims, 1.0::DOUBLE AS stat_length,
       1.0::DOUBLE AS text_length FROM part_stats""",
)
def build_embeddings(spark, sf_dir):
    """Size and length of both blocks of every row; blocks are unit vectors."""
    from kindred.functions.vectors import norm

    built = E.build_embeddings(cut_lineage(part_stats(spark, sf_dir)), method="pca", n_components=8)
    return built.select(
        "row_id", "player", F.size("stat").alias("stat_dims"), F.size("text").alias("text_dims"),
        F.round(norm(F.col("stat")), 6).alias("stat_length"), F.round(norm(F.col("text")), 6).alias("text_length"),
    )


@query(
    "profile_text",
    "WITH " + PART_STATS_SQL + """ SELECT row_id, printf('%s is a %d-year-old %s playing for %s in the %s. He scores %.2f goals per 90 minutes, '
       || 'records %.2f assists per 90, completes %.0f%% of passes, generates %.2f xG per 90, and makes %.2f tackles per 90 minutes.',
       player, coalesce(age, 25)::INTEGER, pos, squad, league, round_even(gls_per90, 2), round_even(ast_per90, 2), round_even(pass_completion_pct, 0),
       round_even(xg_per90, 2), round_even(tackles_tkl_per90, 2)) AS profile FROM part_stats""",
)
def profile_text(spark, sf_dir):
    s = part_stats(spark, sf_dir)
    return s.select("row_id", profile_sentence(s).alias("profile"))


@query(
    "description_search",
    f"""
WITH terms AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(lower(text), '{E.TERM}')) AS term FROM documents
  UNION ALL SELECT 'q', item_id, unnest(regexp_extract_all(lower(text), '{E.TERM}')) FROM benchmark),
counts AS (SELECT kind, id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {E.TEXT_DIMS} AS bucket, count(*) AS tf FROM terms GROUP BY ALL),
idf AS (SELECT bucket, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf FROM counts WHERE kind = 'd' GROUP BY bucket),
weighed AS (SELECT kind, id, bucket, tf * idf AS w FROM counts JOIN idf USING (bucket)),
norms AS (SELECT kind, id, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
dots AS (SELECT q.id AS query_id, d.id AS row_id, sum(q.w * d.w) AS dot FROM weighed q JOIN weighed d USING (bucket)
         WHERE q.kind = 'q' AND d.kind = 'd' GROUP BY ALL),
scored AS (
  SELECT query_id, row_id, dot / (a.norm * b.norm) AS similarity FROM dots
  JOIN norms a ON a.kind = 'q' AND a.id = query_id JOIN norms b ON b.kind = 'd' AND b.id = row_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 12) DESC, row_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, row_id, source AS player, lang AS pos, round_even(round(similarity, 12), 4) AS similarity
FROM ranked JOIN documents ON doc_id = row_id WHERE rank <= 10""",
)
def description_search(spark, sf_dir):
    """Every document as a profile text, benchmark items as descriptions."""
    from kindred.operators.retrieval import description_search as search

    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("player"), F.col("lang").alias("pos"), F.col("text").alias("profile")
    )
    idf, encoded = E.bucket_encode(docs, "row_id")
    wanted = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("profile"))
    asked = E.bucket_vectors(wanted, idf, "query_id").drop("profile")
    found = search(encoded, asked, "text", k=10, columns=["player", "pos"])
    return found.select("query_id", "rank", "row_id", "player", "pos", "similarity")


# ----------------------------------------------------------------------- radar

_RADAR = ["gls_per90", "ast_per90", "xg_per90", "prog_carries_per90", "prog_passes_per90", "tackles_tkl_per90", "int_per90", "pass_completion_pct"]
_RADAR_LABELS = ["Goals/90", "Assists/90", "xG/90", "Prog. Carries/90", "Prog. Passes/90", "Tackles/90", "Interceptions/90", "Pass Completion %"]


def _radar_sql() -> str:
    from kindred.plans.retrieval_queries import _BROAD_SQL

    parts = " UNION ALL ".join(
        f"""SELECT row_id, pos_group, '{f}' AS feature, '{label}' AS label,
              round(CASE WHEN p{i} IS NULL OR p{i} = 0 THEN 0.0 ELSE least({f} / p{i}, 1.0) END, 6) AS value,
              round(CASE WHEN p{i} IS NULL OR p{i} = 0 THEN 0.0 ELSE least(a{i} / p{i}, 1.0) END, 6) AS average, round({f}, 6) AS raw
            FROM grouped JOIN means USING (pos_group), tops"""
        for i, (f, label) in enumerate(zip(_RADAR, _RADAR_LABELS)))
    return (
        "WITH " + PART_STATS_SQL + ", grouped AS (SELECT *, " + _BROAD_SQL.format(p="pos") + " AS pos_group FROM part_stats), means AS (SELECT pos_group, "
        + ", ".join(f"avg({f}) AS a{i}" for i, f in enumerate(_RADAR)) + " FROM grouped GROUP BY pos_group), tops AS (SELECT "
        + ", ".join(f"quantile_cont({f}, 0.95) AS p{i}" for i, f in enumerate(_RADAR)) + " FROM part_stats) " + parts
    )


@query("radar_profiles", _radar_sql())
def radar(spark, sf_dir):
    wide = radar_profiles(cut_lineage(part_stats(spark, sf_dir)))
    return wide.select("row_id", "pos_group", F.inline("radar")).select(
        "row_id", "pos_group", "feature", "label", *[F.round(c, 6).alias(c) for c in ["value", "average", "raw"]]
    )


# ---------------------------------------------------------------------- squads

_SQUAD_CODES = ["GK", "DF", "MF", "FW", "XX"]


@query(
    "squad_append_impute",
    f"""WITH base AS (
      SELECT c_custkey AS row_id, c_name AS player, list_extract({_SQUAD_CODES[:4]!r}, (c_nationkey % 4 + 1)::INTEGER) AS pos,
             c_acctbal AS market_value_eur, c_acctbal / 100 AS pass_completion_pct, 0 AS is_world_cup, 'full_key' AS match_strategy FROM customer),
    squad AS (
      SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 3 = 0 THEN ' ' || replace(lower(s_name), 'supplier', 'customer') ELSE s_name END AS player,
             list_extract({_SQUAD_CODES!r}, (s_nationkey % 5 + 1)::INTEGER) AS pos, 'NAT' || s_nationkey AS nation FROM supplier),
    means AS (SELECT pos AS prefix, avg(market_value_eur) AS mv, avg(pass_completion_pct) AS pc FROM base GROUP BY pos),
    fresh AS (SELECT * FROM squad WHERE lower(trim(player)) NOT IN (SELECT lower(trim(player)) FROM base)),
    added AS (SELECT f.*, m.mv, m.pc FROM fresh f LEFT JOIN means m ON m.prefix = CASE WHEN pos = 'XX' THEN 'MF' ELSE pos END)
    SELECT player, pos, CASE WHEN lower(trim(player)) IN (SELECT lower(trim(player)) FROM squad) THEN 1 ELSE 0 END AS is_world_cup,
           round(market_value_eur, 6) AS market_value_eur, round(pass_completion_pct, 6) AS pass_completion_pct, match_strategy, NULL AS nation FROM base
    UNION ALL
    SELECT player, pos, 1, round(mv * 0.7::DOUBLE, 6), round(pc, 6), 'wc2026_wiki', nation FROM added""",
)
def squad_append_impute(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in _SQUAD_CODES])
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row_id"), F.col("c_name").alias("player"),
        F.element_at(codes, (F.col("c_nationkey") % 4 + 1).cast("int")).alias("pos"),
        F.col("c_acctbal").alias("market_value_eur"), (F.col("c_acctbal") / 100).alias("pass_completion_pct"),
        F.lit(0).alias("is_world_cup"), F.lit("full_key").alias("match_strategy"),
    )
    renamed = F.concat(F.lit(" "), F.replace(F.lower("s_name"), F.lit("supplier"), F.lit("customer")))
    squad = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("row_id"),
        F.when(F.col("s_suppkey") % 3 == 0, renamed).otherwise(F.col("s_name")).alias("player"),
        F.element_at(codes, (F.col("s_nationkey") % 5 + 1).cast("int")).alias("pos"),
        F.concat(F.lit("NAT"), F.col("s_nationkey").cast("string")).alias("nation"),
    )
    return append_squads(base, squad).select(
        "player", "pos", "is_world_cup", F.round("market_value_eur", 6).alias("market_value_eur"),
        F.round("pass_completion_pct", 6).alias("pass_completion_pct"), "match_strategy", "nation",
    )



