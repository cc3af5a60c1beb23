"""Registered queries: text functions, HTML sources, requests, enrichment, synthesis."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions import constants as K
from kindred.functions import text as X
from kindred.functions.columns import clean_column_names
from kindred.operators import enrich as N
from kindred.operators import filters as W
from kindred.operators import requests as Q
from kindred.operators.features import encode_text, text_pipeline, unit_blocks
from kindred.operators.retrieval import stat_text_weights
from kindred.plans.registry import query
from kindred.plans.tables import PEOPLE_SQL, PROFILES_SQL, block_profiles, people, profiles, table
from kindred.session import cut_lineage, shuffled, spread
from kindred.sources import html as H
from kindred.sources.synthetic import synthesise
from kindred.sources.tables import map_alternate

# ----------------------------------------------------------------- normalisers


@query(
    "name_normalise",
    """SELECT doc_id, md5(folded) AS folded, md5(folded || ' | ' || lower(source)) AS full_key, md5(plain) AS plain
       FROM (SELECT doc_id, source, trim(lower(strip_accents(text)), ' ' || chr(9) || chr(10) || chr(13)) AS folded,
                    trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9 ]', ' ', 'g')) AS plain FROM documents)""",
)
def name_normalise(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    folded = d.select(
        "doc_id", X.fold_name("text").alias("folded"), X.fold_name("source").alias("club"), X.fold_plain(F.col("text")).alias("plain")
    )
    return folded.select(
        "doc_id", F.md5("folded").alias("folded"), F.md5(X.match_key(F.col("folded"), F.col("club"))).alias("full_key"), F.md5("plain").alias("plain")
    )


# Row number modulo 7 decides the spelling of a price.
_MONEY_SQL = """SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '€' || p_size || 'm' WHEN 1 THEN '€' || p_size || ',5m' WHEN 2 THEN '€' || p_size || 'k'
  WHEN 3 THEN p_size || '.2bn' WHEN 4 THEN '-' WHEN 5 THEN 'free transfer' ELSE ' €' || p_size || ' ' END AS raw, p_size::DOUBLE AS s FROM part"""


@query(
    "money_parse",
    f"""SELECT p_partkey, raw, CASE p_partkey % 7 WHEN 0 THEN s * 1e6 WHEN 1 THEN (s + 0.5) * 1e6 WHEN 2 THEN s * 1e3 WHEN 3 THEN (p_s || '.2')::DOUBLE * 1e9
        WHEN 6 THEN s END AS value FROM (SELECT *, s::INTEGER::VARCHAR AS p_s FROM ({_MONEY_SQL}))""",
)
def money_parse(spark, sf_dir):
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 7
    raw = (
        F.when(kind == 0, F.concat(F.lit("€"), size, F.lit("m"))).when(kind == 1, F.concat(F.lit("€"), size, F.lit(",5m")))
        .when(kind == 2, F.concat(F.lit("€"), size, F.lit("k"))).when(kind == 3, F.concat(size, F.lit(".2bn")))
        .when(kind == 4, F.lit("-")).when(kind == 5, F.lit("free transfer")).otherwise(F.concat(F.lit(" €"), size, F.lit(" ")))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return parts.withColumn("value", X.parse_money(F.col("raw")))


@query(
    "money_format",
    """SELECT o_orderkey, CASE WHEN v IS NULL THEN 'N/A' WHEN v >= 1e6 THEN printf('€%.1fM', round_even(v / 1e6, 1))
              WHEN v >= 1e3 THEN printf('€%.0fK', round_even(v / 1e3, 0)) ELSE '€' || printf('%.0f', round_even(v, 0)) END AS shown
       FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_totalprice * 37 WHEN 2 THEN o_totalprice ELSE o_totalprice / 1000 END AS v FROM orders)""",
)
def money_format(spark, sf_dir):
    kind, price = F.col("o_orderkey") % 4, F.col("o_totalprice")
    value = F.when(kind == 1, price * 37).when(kind == 2, price).when(kind == 3, price / 1000)
    return table(spark, sf_dir, "orders").select("o_orderkey", X.format_money(value).alias("shown"))


@query(
    "column_cleaning",
    "SELECT p_partkey AS \"0_rk\", p_name AS playing_time_min, p_brand AS per90_gls, p_type AS xg_npxg, p_size AS prog_prgc, p_retailprice AS gls FROM part",
)
def column_cleaning(spark, sf_dir):
    names = ["Unnamed: 0_level_0_Rk", "Playing Time_Min.", "Per 90 Minutes_Gls", "Expected_npxG", "Progression_PrgC", "Performance_Gls"]
    return clean_column_names(table(spark, sf_dir, "part").toDF(*names))


@query(
    "alternate_source",
    """SELECT p_name AS player, p_brand AS squad, minutes AS playing_time_min, gls, ast, round_even(gls / (minutes / 90.0::DOUBLE), 4) AS gls_per90,
              round_even(ast / (minutes / 90.0::DOUBLE), 4) AS ast_per90
       FROM (SELECT p_name, p_brand, (p_size * 37)::DOUBLE AS minutes, (p_partkey % 20)::DOUBLE AS gls, (p_partkey % 13)::DOUBLE AS ast FROM part) WHERE minutes >= 450""",
)
def alternate_source(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("short_name"), F.col("p_brand").alias("club_name"), (F.col("p_size") * 37).cast("string").alias("minutes_played"),
        (F.col("p_partkey") % 20).cast("string").alias("goals_scored"), (F.col("p_partkey") % 13).cast("string").alias("assists"),
    )
    return map_alternate(raw)


# -------------------------------------------------------------------- addresses


@query(
    "url_quality",
    """SELECT page_id, url LIKE 'http%' AND NOT regexp_matches(lower(url), 'thth|/fr/|#top') AS usable,
              substr(md5(url), 1, 12) AS cache_key,
              CASE WHEN regexp_extract(split_part(url, '?', 1), '\\.([^.]*)$', 1) IN ('jpg', 'jpeg', 'png', 'webp', 'gif')
                   THEN regexp_extract(split_part(url, '?', 1), '\\.([^.]*)$', 1) ELSE 'jpg' END AS extension,
              lower(trim(regexp_replace(regexp_replace(url, '[^a-zA-Z0-9_-]', '_', 'g'), '_+', '_', 'g'), '_')) AS slug
       FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '/a.PNG?x=1' WHEN 1 THEN 'ftp' || url ELSE url END AS url0, lower(url0) AS url FROM pages)""",
)
def url_quality(spark, sf_dir):
    kind = F.col("page_id") % 4
    changed = F.when(kind == 0, F.concat("url", F.lit("/a.PNG?x=1"))).when(kind == 1, F.concat(F.lit("ftp"), "url")).otherwise(F.col("url"))
    p = table(spark, sf_dir, "pages").select("page_id", F.lower(changed).alias("url"))
    url = F.col("url")
    return p.select(
        "page_id", X.usable_url(url, ["thth", "/fr/", "#top"]).alias("usable"), X.cache_key(url).alias("cache_key"),
        X.image_extension(url).alias("extension"), X.slug(url).alias("slug"),
    )


@query(
    "first_usable",
    """SELECT lang, arg_min(url, {'i': coalesce(idx, 999), 'u': url}) AS url
       FROM (SELECT regexp_extract(url, '/([a-z][a-z])/', 1) AS lang, url, CASE WHEN page_id % 5 <> 0 THEN page_id % 5 END AS idx FROM pages)
       WHERE NOT regexp_matches(lower(url), '\\.svg|flag|logo|shield|crest|thth') GROUP BY lang""",
)
def first_usable(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("lang"), "url", F.when(F.col("page_id") % 5 != 0, F.col("page_id") % 5).alias("idx")
    )
    return N.first_candidate(p, "lang", "url", "idx", [*K.SEARCH_DENY, "thth"])


@query(
    "image_fallback",
    """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 AND NOT regexp_matches(lower(url), 'milan_|inter_|_vs_') THEN url
                            WHEN page_id % 3 = 2 THEN NULL END AS image FROM pages""",
)
def image_fallback(spark, sf_dir):
    kind = F.col("page_id") % 3
    p = table(spark, sf_dir, "pages").select(
        "page_id", F.when(kind == 0, F.concat(F.lit(" "), "url")).alias("sportsdb_image_url"), F.when(kind == 1, F.col("url")).alias("image_url"),
        F.when(kind == 2, F.lit("static/x.jpg")).alias("local_image_path"),
    )
    return p.select("page_id", X.best_image(p).alias("image"))


# ------------------------------------------------------------------ HTML sources


@query(
    "html_links",
    """SELECT page_id, i::INTEGER AS tm_rank, kept[i] AS similar_player
       FROM (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?s)<a\\b[^>]*>(.*?)</a>', 1),
                    lambda a: trim(regexp_replace(a, '<[^>]*>', '', 'g'))), lambda t: length(t) > 2)[1:10] AS kept FROM pages), range(1, 11) r(i)
       WHERE i <= len(kept)""",
)
def html_links(spark, sf_dir):
    return H.link_texts(table(spark, sf_dir, "pages"))


_LINES_SQL = "SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem"


def _order_pages(spark, sf_dir, head, row, tail):
    """One HTML page per order, one table row per line item."""
    li = table(spark, sf_dir, "lineitem")
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    grouped = spread(li, "l_orderkey").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    body = F.array_join(F.transform("lines", row), "")
    return grouped.select("page_id", F.lit("League").alias("league"), F.concat(F.lit(head), body, F.lit(tail)).alias("html"))


def _td(value, attrs: str = ""):
    return F.concat(F.lit(f"<td{attrs}>"), value.cast("string"), F.lit("</td>"))


@query(
    "html_statistics_table",
    f"SELECT l_orderkey AS page_id, l_partkey::VARCHAR AS player, l_quantity::VARCHAR AS gls, l_linenumber::VARCHAR AS playing_time_min FROM ({_LINES_SQL})",
)
def html_statistics_table(spark, sf_dir):
    head = (
        '<html><body><table id="other"><tr><td>x</td></tr></table><table id="x_stats_standard_9"><thead>'
        '<tr><th></th><th></th><th>Playing Time</th><th colspan="2">Performance</th></tr>'
        "<tr><th>Rk</th><th>Player</th><th>Min</th><th>Gls</th><th>Ast</th></tr></thead><tbody>"
    )
    repeat = "<tr><th>Rk</th><th>Player</th><th>Min</th><th>Gls</th><th>Ast</th></tr>"

    def row(x):
        cells = F.concat(_td(F.lit("1")), _td(x["l_partkey"]), _td(x["l_linenumber"]), _td(x["l_quantity"]), _td(F.lit("0")))
        return F.concat(F.lit("<tr>"), cells, F.lit("</tr>" + repeat))

    found = H.statistics_tables(_order_pages(spark, sf_dir, head, row, "</tbody></table></body></html>"))
    stat = lambda name: F.element_at("stats", F.lit(name)).alias(name.split("rk_")[-1])
    return found.select("page_id", F.element_at("stats", F.lit("1_player")).alias("player"), stat("gls"), stat("playing_time_min"))


@query(
    "html_value_listing",
    f"""SELECT l_orderkey AS page_id, 'P' || l_partkey AS player, l_returnflag AS position_detail, l_linenumber::VARCHAR AS age_tm, l_quantity * 1e6 AS market_value_eur
        FROM ({_LINES_SQL}) WHERE l_linenumber % 3 <> 0""",
)
def html_value_listing(spark, sf_dir):
    def row(x):
        name = F.concat(F.lit('<td><a class="spielprofil_tooltip x" href="#">P'), x["l_partkey"].cast("string"), F.lit("</a></td>"))
        full = F.concat(
            F.lit('<tr class="odd">'), name, _td(x["l_returnflag"], ' class="posrela"'), _td(x["l_linenumber"], ' class="zentriert"'), _td(F.lit("")),
            F.lit('<td class="rechts hauptlink">€'), x["l_quantity"].cast("string"), F.lit("m</td></tr>"),
        )
        return F.when(x["l_linenumber"] % 3 == 0, F.concat(F.lit('<tr class="even">'), name, F.lit("</tr>"))).otherwise(full)

    pages = _order_pages(spark, sf_dir, '<table class="items big"><tr><th>head</th></tr>', row, "</table>")
    return H.value_listings(pages).select("page_id", "player", "position_detail", "age_tm", "market_value_eur")


@query(
    "html_squads",
    f"""SELECT l_orderkey AS page_id, 'P' || l_partkey AS player, CASE l_linenumber % 4 WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' WHEN 2 THEN 'MF' ELSE 'FW' END AS pos,
               'BRA' AS nation, 'Club' || l_suppkey AS squad, 'Brazil' AS nationality_tm FROM ({_LINES_SQL})""",
)
def html_squads(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in ("1GK", "2DF", "3MF", "4FW")])

    def row(x):
        name = F.concat(F.lit("P"), x["l_partkey"].cast("string"), F.lit(" (captain) [1]"))
        cells = F.concat(_td(F.lit("9")), _td(F.element_at(codes, x["l_linenumber"] % 4 + 1)), _td(name), _td(F.lit("30")))
        return F.concat(F.lit("<tr>"), cells, _td(F.concat(F.lit("Club"), x["l_suppkey"].cast("string"))), F.lit("</tr>"))

    head = '<h2>References</h2><h2>Group A</h2><h3>Atlantis</h3><h3>Brazil</h3><p>text</p><table class="wikitable"><tr><th>No.</th><th>Pos.</th></tr>'
    pages = _order_pages(spark, sf_dir, head, row, "</table>")
    return H.squad_sections(pages).select("page_id", "player", "pos", "nation", "squad", "nationality_tm")


# -------------------------------------------------------------------- countries

_CODES = ["ENG", "BRA", "FRA", "CHN", "XYZ", "bra", "KSA", "USA", "CIV", "MAR"]


@query(
    "country_filter",
    f"""WITH c AS (SELECT c_custkey, list_extract({_CODES!r}, (n_nationkey % 10 + 1)::INTEGER) AS nation, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, nation, CASE upper(nation) WHEN 'BRA' THEN 'Brazil' WHEN 'FRA' THEN 'France' ELSE 'United States' END AS label,
           CASE upper(nation) WHEN 'BRA' THEN 'br' WHEN 'FRA' THEN 'fr' ELSE 'us' END AS flag FROM c WHERE upper(nation) IN ('BRA', 'FRA', 'USA')""",
)
def country_filter(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in _CODES])
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    people_of = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.element_at(codes, (F.col("n_nationkey") % 10 + 1).cast("int")).alias("nation")
    )
    kept = W.country_filter(people_of, ["Brazil 🇧🇷", "fra", "United States"])
    nation = X.nation_text(kept)
    return kept.select("c_custkey", "nation", X.nation_label(nation).alias("label"), X.flag_key(nation).alias("flag"))


# --------------------------------------------------------------------- requests

# Request number modulo 6 decides the clause appended to a user turn.
_CLAUSES = [
    " striker under €80m", " budget 30,000,000 midfielder", " fast winger under 30 million",
    " world cup goalkeeper max 12.5m", " nothing special", " center back cost £7 m",
]


def _user_requests(spark, sf_dir, clause):
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    number = F.col("conv_id") * 100 + F.col("turn")
    return c.select(number.alias("query_id"), F.concat("text", clause(number)).alias("query"))


def _request_sql() -> str:
    def first(pattern):
        return f"try_cast(replace(nullif(regexp_extract(q, '{pattern}', 1), ''), ',', '') AS DOUBLE)"

    position = " ".join(f"WHEN regexp_matches(q, '\\b{w}\\b') THEN '{code}'" for w, code in K.REQUEST_POSITIONS.items())
    style = "q"
    for p in K.MONEY_TEXT_PATTERNS:
        style = f"regexp_replace({style}, '{p}', '', 'g')"
    for phrase in K.REQUEST_FILLERS:
        style = f"regexp_replace({style}, '\\b{phrase}\\b', ' ', 'g')"
    return f"""
SELECT query_id, coalesce({first(K.MILLION_PATTERNS[0])} * 1e6, {first(K.MILLION_PATTERNS[1])} * 1e6, {first(K.FULL_NUMBER_PATTERN)},
                          {first(K.ANY_MILLION_PATTERN)} * 1e6) AS budget,
       CASE {position} END AS position, contains(q, 'world cup') OR contains(q, 'wc') OR contains(q, 'national team') AS wants_flag,
       md5(trim(regexp_replace({style}, '\\s+', ' ', 'g'))) AS style
FROM (SELECT conv_id * 100 + turn AS query_id, lower(text || list_extract({_CLAUSES!r}, ((conv_id * 100 + turn) % 6 + 1)::INTEGER)) AS q
      FROM conversations WHERE role = 'user')"""


@query("request_parsing", _request_sql())
def request_parsing(spark, sf_dir):
    clauses = F.array(*[F.lit(c) for c in _CLAUSES])
    asked = _user_requests(spark, sf_dir, lambda n: F.element_at(clauses, (n % 6 + 1).cast("int")))
    parsed = Q.parse_requests(asked)
    return parsed.select("query_id", "budget", "position", "wants_flag", F.md5("style").alias("style"))


def _about_people(spark, sf_dir, clause):
    """User turns, each with a clause about one person."""
    p = people(spark, sf_dir)
    n = p.agg(F.count(F.lit(1))).scalar()
    turns = _user_requests(spark, sf_dir, lambda number: F.lit("")).withColumn("row_id", (F.col("query_id") * 31) % n)
    return turns.join(shuffled(p.select("row_id", "first", "last", "player")), "row_id").select("query_id", clause.alias("query")), p


@query(
    "request_reference",
    "WITH " + PEOPLE_SQL + """
SELECT conv_id * 100 + turn AS query_id, player AS reference,
       CASE WHEN (conv_id * 100 + turn) % 2 = 0 THEN 'mention' ELSE 'cue' END AS step,
       CASE WHEN (conv_id * 100 + turn) % 2 = 0 THEN first ELSE substr(first, 1, 6) || substr(first, 8) || ' ' || last || 'e' END AS segment
FROM conversations JOIN people ON row_id = ((conv_id * 100 + turn) * 31) % (SELECT count(*) FROM people) WHERE role = 'user'""",
)
def request_reference(spark, sf_dir):
    typo = F.concat(F.substring("first", 1, 6), F.substring("first", 8, 9), F.lit(" "), "last", F.lit("e"))
    clause = F.when(F.col("query_id") % 2 == 0, F.concat("query", F.lit(". Similar to "), F.upper("player"))).otherwise(
        F.concat("query", F.lit(". Someone like "), typo)
    )
    asked, p = _about_people(spark, sf_dir, clause)
    return Q.reference_names(asked, p).select("query_id", "reference", "step", "segment")


@query(
    "request_scan",
    "WITH " + PEOPLE_SQL + " SELECT row_id AS query_id, player AS reference, 'scan' AS step, substr(last, 1, 5) || substr(last, 7) AS segment FROM people",
)
def request_scan(spark, sf_dir):
    """Short requests whose only clue is a misspelt last word."""
    p = people(spark, sf_dir)
    typo = F.concat(F.substring("last", 1, 5), F.substring("last", 7, 6))
    asked = p.select(F.col("row_id").alias("query_id"), F.concat(F.lit("get me "), typo, F.lit(" now")).alias("query"))
    return Q.reference_names(asked, p).select("query_id", "reference", "step", "segment")


@query("request_answers")
def request_answers(spark, sf_dir):
    """One request per profile, routed by its wording and answered in one job."""
    p = block_profiles(spark, sf_dir).withColumn("market_value_eur", F.col("market_value_eur") * 1e6).drop("text")
    model_input = p.withColumn("profile", F.concat_ws(" ", "player", "squad", "league", "pos"))
    model = text_pipeline().fit(model_input)
    vectors = unit_blocks(encode_text(model_input, model).drop("profile"), ["stat", "text"])
    kind = F.col("row_id") % 4
    wording = (
        F.when(kind == 0, F.concat(F.lit("striker like "), "player", F.lit(" under 920 million")))
        .when(kind == 1, F.concat(F.lit("world cup player similar to "), "player"))
        .when(kind == 2, F.concat(F.lit("blue or red promo under "), (F.col("age") + 900).cast("string"), F.lit("m")))
        .otherwise(F.concat(F.lit("replacement for "), "player", F.lit(" quick economy")))
    )
    asked = p.select(F.col("row_id").alias("query_id"), wording.alias("query"))
    parsed = cut_lineage(Q.parse_requests(asked, p))
    return Q.answer_requests(parsed, vectors, stat_text_weights(0.6), "text", lambda d: encode_text(d, model)).select(
        "query_id", "rank", "row_id", "player", "similarity"
    )


_NATIONS = ["ENG", "FRA", "BRA", "ESP", "GER"]


@query(
    "request_chosen",
    "WITH " + PROFILES_SQL + f""",
people AS (SELECT *, list_extract({_NATIONS!r}, (row_id % 5 + 1)::INTEGER) AS nation FROM profiles),
asked AS (
  SELECT q.row_id AS query_id, r.row_id, r.vec, CASE q.row_id % 3 WHEN 1 THEN ['ENG'] WHEN 2 THEN ['FRA', 'BRA'] END AS codes
  FROM people q JOIN people r ON r.row_id = (q.row_id * 7 + 3) % (SELECT count(*) FROM people)),
ranked AS (
  SELECT query_id, codes, c.row_id, c.player, c.nation, round(list_cosine_similarity(a.vec, c.vec), 12) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(a.vec, c.vec), 12) DESC, c.row_id)::INTEGER AS rank
  FROM asked a JOIN people c ON c.row_id <> a.row_id),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS shown FROM ranked
  WHERE rank <= 25 AND (codes IS NULL OR list_contains(codes, nation)))
SELECT query_id, rank, row_id, player, nation, round_even(score, 4) AS similarity FROM kept WHERE shown <= 5""",
)
def request_chosen(spark, sf_dir):
    """Requests with a reference chosen beside the text, and with countries selected after the cut."""
    p = profiles(spark, sf_dir).withColumn("nation", F.element_at(F.array(*[F.lit(x) for x in _NATIONS]), (F.col("row_id") % 5).cast("int") + 1))
    n = p.agg(F.count(F.lit(1))).scalar()
    kind, nobody = F.col("row_id") % 3, F.lit(None).cast("array<string>")
    countries = F.when(kind == 1, F.array(F.lit("eng"))).when(kind == 2, F.array(F.lit("France"), F.lit("BRA"))).otherwise(nobody)
    wanted = p.select(F.col("row_id").alias("query_id"), countries.alias("countries"), ((F.col("row_id") * 7 + 3) % n).alias("row_id"))
    asked = wanted.join(shuffled(p.select("row_id", F.col("player").alias("chosen"))), "row_id").select("query_id", "countries", "chosen", F.lower("chosen").alias("query"))
    parsed = cut_lineage(Q.parse_requests(asked, p))
    answered = Q.answer_requests(parsed, p, {"vec": 1.0}, "vec", lambda d: d.withColumn("vec", F.lit(None).cast("array<double>")))
    return answered.select("query_id", "rank", "row_id", "player", "nation", "similarity")


# ------------------------------------------------------------------- enrichment


@query(
    "incremental_enrich",
    "SELECT doc_id, source, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def incremental_enrich(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return N.not_done(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "enrich_pending",
    """SELECT doc_id, source, CASE doc_id % 3 WHEN 0 THEN 'http://kept/' || doc_id WHEN 1 THEN 'http://found/' || source ELSE
       CASE WHEN source IN ('src1', 'src2') THEN NULL ELSE 'http://found/' || source END END AS url
       FROM documents WHERE NOT (doc_id % 3 = 1 AND source IN ('src1', 'src2'))
       UNION ALL SELECT doc_id, source, NULL FROM documents WHERE doc_id % 3 = 1 AND source IN ('src1', 'src2')""",
)
def enrich_pending(spark, sf_dir):
    kind = F.col("doc_id") % 3
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.when(kind == 0, F.concat(F.lit("http://kept/"), F.col("doc_id").cast("string"))).when(kind == 1, F.lit("n/a")).alias("url")
    )
    resolve = lambda names: names.where(~F.col("name").isin("src1", "src2")).withColumn("url", F.concat(F.lit("http://found/"), "name"))
    named = docs.withColumn("name", F.col("source"))
    pending_only = N.pending_rows(named, "url", "name")
    filled = N.enrich(pending_only, "url", resolve, "name")
    kept = named.where(~X.needs_value(F.col("url")))
    return kept.unionByName(filled).select("doc_id", "source", "url")


# --------------------------------------------------------------------- synthesis


_FLAGGED = ["Customer#000000004", "Customer#000000009"]


def _synthetic_sql() -> str:
    def uniform(field):
        return f"(('0x' || substr(md5(row_id || '/{field}/42'), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE"

    def by_position(values, default):
        return "CASE pos " + " ".join(f"WHEN '{p}' THEN {v!r}::DOUBLE" for p, v in values.items()) + f" ELSE {default!r}::DOUBLE END"

    columns = []
    for stat, width in K.SYNTHETIC_SPREAD.items():
        mean = by_position({p: m[stat] for p, m in K.SYNTHETIC_MEANS.items()}, 0.0)
        drawn = f"{width!r}::DOUBLE * sqrt(-2.0::DOUBLE * ln({uniform(stat + '/r')})) * cos(2.0::DOUBLE * 3.141592653589793::DOUBLE * {uniform(stat + '/a')})"
        if stat == "pass_completion_pct":
            columns.append(f"round(least(98.0::DOUBLE, greatest(45.0::DOUBLE, {mean} + {drawn})), 1) AS {stat}")
        else:
            columns.append(f"greatest(0.0::DOUBLE, round({mean} * factor + {drawn}, 3)) AS {stat}")
    peak = "greatest(0.25::DOUBLE, 1.2::DOUBLE - greatest(0, age - 25) * 0.07::DOUBLE)"
    value = f"round({by_position(K.SYNTHETIC_BASE_VALUE, 10e6)} * {peak} * (0.4::DOUBLE + 1.8::DOUBLE * {uniform('value')}), -4)"
    return f"""
WITH names AS (
  SELECT c_custkey AS row_id, c_name AS player, list_extract({list(K.SQUAD_PREFIXES)!r}, (c_custkey % 4 + 1)::INTEGER) AS pos,
         (c_custkey % 22 + 17)::INTEGER AS age, list_extract({_CODES!r}, (c_nationkey % 10 + 1)::INTEGER) AS nation,
         c_acctbal > 9000 AS is_elite, CASE WHEN c_acctbal > 9000 THEN {K.ELITE_FACTOR}::DOUBLE ELSE 1.0::DOUBLE END AS factor FROM customer),
made AS (
  SELECT *, {", ".join(columns)}, floor(900 + 2400 * {uniform("minutes")})::INTEGER AS playing_time_min, {value} AS market_value_eur,
         '202' || floor(5 + 4 * {uniform("contract")})::INTEGER AS contract_expires,
         CASE WHEN nation IN ({", ".join(map(repr, K.FLAGGED_NATIONS))}) OR player IN ({", ".join(map(repr, _FLAGGED))}) THEN 1 ELSE 0 END AS is_world_cup
  FROM names)
SELECT * EXCLUDE (factor), '€' || printf('%.1f', floor(market_value_eur / 1e5 + 0.5 + 1e-9) / 10) || 'M' AS market_value_raw FROM made"""


@query("synthetic_profiles", _synthetic_sql())
def synthetic_profiles(spark, sf_dir):
    """Synthetic statistics for every customer."""
    codes = F.array(*[F.lit(c) for c in K.SQUAD_PREFIXES])
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row_id"), F.col("c_name").alias("player"),
        F.element_at(codes, (F.col("c_custkey") % 4 + 1).cast("int")).alias("pos"), (F.col("c_custkey") % 22 + 17).cast("int").alias("age"),
        F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("c_nationkey") % 10 + 1).cast("int")).alias("nation"),
        (F.col("c_acctbal") > 9000).alias("is_elite"),
    )
    return synthesise(names, flagged_names=_FLAGGED)
