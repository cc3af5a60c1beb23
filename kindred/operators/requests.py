"""Free-text requests, parsed in bulk: budget, position, flag, reference name, style.

``requests(query_id, query)`` in; every step is a column expression or a join,
so a table of requests is parsed in one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import constants as K
from kindred.functions.columns import detect_col
from kindred.functions.text import drop_phrases, label_to_code, whole_word
from kindred.functions.positions import broad_group, contains_code
from kindred.functions.vectors import numpy_cosine
from kindred.operators import retrieval as R
from kindred.operators.linkage import best_fuzzy, last_name_dimension, near_best
from kindred.session import cut_lineage, numbered, shuffled

FUZZY_FLOOR = 60.0
TEXT_SHARE = 0.6

# -------------------------------------------------------------- scalar criteria


def _number(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def budget(text: Column) -> Column:
    """Largest value asked for, in EUR, by the first pattern that matches.

    A number written out in full is taken as it stands; only a number followed
    by ``m`` or ``million`` counts millions.
    """
    millions = [_number(text, p) * 1e6 for p in K.MILLION_PATTERNS]
    first = F.coalesce(*millions, _number(text, K.FULL_NUMBER_PATTERN))
    return F.coalesce(F.nullif(first, F.lit(0.0)), _number(text, K.ANY_MILLION_PATTERN) * 1e6)


def position(text: Column) -> Column:
    """Code of the first listed keyword found as a whole word."""
    return reduce(lambda acc, kv: acc.when(whole_word(text, kv[0]), kv[1]), K.REQUEST_POSITIONS.items(), F)


def wants_flag(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in K.REQUEST_FLAG_PHRASES])


def style_text(text: Column, reference: Column, segment: Column) -> Column:
    """What is left after money, names and filler phrases are taken out."""
    plain = reduce(lambda t, p: F.regexp_replace(t, p, ""), K.MONEY_TEXT_PATTERNS, text)
    name = F.coalesce(F.lower(reference), F.lit(""))

    def without(source: Column, part: Column) -> Column:
        return F.when(part != "", F.replace(source, part, F.lit(""))).otherwise(source)

    plain = without(plain, name)
    long_parts = F.filter(F.split(name, r"\s+"), lambda p: F.length(p) > 2)
    plain = F.aggregate(long_parts, plain, lambda acc, p: F.replace(acc, p, F.lit("")))
    plain = without(plain, F.coalesce(segment, F.lit("")))
    return F.trim(F.regexp_replace(drop_phrases(plain, K.REQUEST_FILLERS), r"\s+", " "))


# ----------------------------------------------------------------- reference name


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)(\w+)"), F.lit(1))


def mentioned_names(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Step A: a word of a name, longer than two letters, stands in the request.

    The longest name wins, then the alphabetically first.  Only the best name
    of each word is kept before the join, so a word shared by very many names
    is one row.  ``requests(query_id, text)``, ``names(player)``.
    """
    lowered = names.select("player", F.posexplode(F.split(F.lower("player"), r"\s+")).alias("nth", "word"))
    usable = lowered.where((F.length("word") > 2) & ~F.col("word").isin(K.REQUEST_STOP_WORDS))
    rank = F.struct(-F.length("player"), F.col("player"), F.col("nth"))
    best_per_word = (
        usable.groupBy("word").agg(F.min(F.struct(rank.alias("rank"), F.col("player"))).alias("b"))
        .select("word", "b.rank", "b.player", F.get(_words(F.col("word")), F.lit(0)).alias("token"))
        .where(F.col("token").isNotNull())
    )
    tokens = requests.select("query_id", "text", F.explode(F.array_distinct(_words(F.col("text")))).alias("token"))
    whole = F.regexp_like(F.col("text"), F.concat(F.lit(r"(?U)\b\Q"), F.col("word"), F.lit(r"\E\b")))
    met = tokens.join(shuffled(best_per_word), "token").where(whole)
    picked = met.groupBy("query_id").agg(F.min_by(F.struct("player", "word"), "rank").alias("b"))
    return picked.select("query_id", F.col("b.player").alias("reference"), F.col("b.word").alias("segment"), F.lit("mention").alias("step"))


def _distinct_texts(df: DataFrame) -> DataFrame:
    return numbered(df.select("text").distinct(), "query_id")


def _sorted_names(names: DataFrame) -> DataFrame:
    """``(text, player, row_id)``: names numbered alphabetically, one per lower-cased text.

    Ties between equal scores follow that order.
    """
    ordered = numbered(names.select("player").distinct(), "row_id", "player")
    return ordered.groupBy(F.lower("player").alias("text")).agg(F.min("player").alias("player"), F.min("row_id").alias("row_id"))


def cued_names(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Step B: the text after a cue such as ``like``, matched fuzzily (at least 60)."""
    def cut(number: int, cue: str) -> Column:
        found = F.regexp_extract_all("text", F.lit(f"{cue}({K.REQUEST_NAME_LETTERS})"), F.lit(1))
        clean = F.transform(found, lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
        squeezed = lambda s: F.regexp_replace(s, r"\s+", " ")  # noqa: E731  for matching; the segment itself is taken out later
        return F.transform(clean, lambda s, i: F.struct(F.lit(number).alias("cue"), i.alias("nth"), s.alias("segment"), squeezed(s).alias("text")))

    segments = requests.select("query_id", F.inline(F.concat(*[cut(n, cue) for n, cue in enumerate(K.REQUEST_CUES)]))).where(F.length("segment") >= 3)
    known = _sorted_names(names)
    texts = _distinct_texts(segments)
    near = near_best(texts, known)
    # what stands behind a segment already named cannot win any more
    settled = texts.join(shuffled(near), "query_id").select("text")
    place = F.struct("cue", "nth")
    first = segments.join(shuffled(settled), "text").groupBy("query_id").agg(F.min(place).alias("first"))
    waiting = segments.join(shuffled(first), "query_id", "left").where(F.col("first").isNull() | (place < F.col("first"))).select("text").distinct()
    rest = texts.join(shuffled(waiting), "text", "left_semi").join(shuffled(near), "query_id", "left_anti")
    best = near.unionByName(best_fuzzy(rest, known.select("row_id", "text"), FUZZY_FLOOR))
    named = texts.join(shuffled(best), "query_id").join(shuffled(known.select("row_id", "player")), "row_id").select("text", "player")
    picked = segments.join(shuffled(named), "text").groupBy("query_id").agg(
        F.min_by(F.struct("player", "segment"), F.struct("cue", "nth")).alias("b")
    )
    return picked.select("query_id", F.col("b.player").alias("reference"), F.col("b.segment").alias("segment"), F.lit("cue").alias("step"))


def _word_grams(text: Column, n: int) -> Column:
    words = F.split(F.trim(text), r"\s+")
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts, lambda i: F.struct(F.lit(n).alias("n"), i.alias("nth"), F.array_join(F.slice(words, i, n), " ").alias("gram"))
    )


def scanned_names(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Step C: every run of one to three words, against last names, then full names.

    The best score of at least 60 wins; equal scores go to the earlier, shorter run.
    Where a run is over ``NEAR`` similar to a last name, only a run that near a full name can
    still win; the request's other runs are not compared.
    """
    grams = requests.select("query_id", F.inline(F.concat(*[_word_grams(F.col("text"), n) for n in (1, 2, 3)])))
    grams = grams.where((F.length("gram") >= 3) & ~F.col("gram").isin(K.REQUEST_SKIPPED_GRAMS))
    texts = _distinct_texts(grams.select(F.col("gram").alias("text")))
    dimension = _sorted_names(names).select(F.col("text").alias("name"), F.col("row_id").alias("ord"), "player")
    last = last_name_dimension(dimension.withColumn("row_id", F.col("ord")))  # of one last name the alphabetically last holder
    last_names = last.select(F.col("last_ord").alias("row_id"), F.col("last").alias("text"))
    full_names = dimension.select(F.col("ord").alias("row_id"), F.col("name").alias("text"))
    near_last = near_best(texts, last_names)
    unsettled = texts.join(shuffled(near_last), "query_id", "left_anti")
    near_full = near_best(unsettled, full_names)
    sure = grams.join(shuffled(texts.join(shuffled(near_last), "query_id").select(F.col("text").alias("gram"))), "gram").select("query_id").distinct()
    waiting = grams.join(shuffled(sure), "query_id", "left_anti").select(F.col("gram").alias("text")).distinct()
    open_texts = unsettled.join(shuffled(waiting), "text", "left_semi").unionByName(
        unsettled.join(shuffled(near_full), "query_id", "left_semi").join(shuffled(waiting), "text", "left_anti")
    )
    open_texts = cut_lineage(open_texts)
    by_last = cut_lineage(near_last.unionByName(best_fuzzy(open_texts, last_names, FUZZY_FLOOR)))
    rest = open_texts.join(shuffled(by_last), "query_id", "left_anti")
    known = near_full.join(shuffled(rest), "query_id", "left_semi")
    by_full = known.unionByName(best_fuzzy(rest.join(shuffled(known), "query_id", "left_anti"), full_names, FUZZY_FLOOR))
    by_last = by_last.withColumnRenamed("row_id", "last_ord").join(shuffled(last.select("last_ord", "name")), "last_ord")
    by_last = by_last.join(shuffled(dimension.select("name", "player")), "name").select("query_id", "player", "score")
    by_full = by_full.withColumnRenamed("row_id", "ord").join(shuffled(dimension.select("ord", "player")), "ord").select("query_id", "player", "score")
    scored = texts.join(shuffled(by_last.unionByName(by_full)), "query_id").select(F.col("text").alias("gram"), "player", "score")
    picked = grams.join(shuffled(scored), "gram").groupBy("query_id").agg(
        F.max_by(F.struct("player", "gram"), F.struct(F.col("score"), -F.col("n"), -F.col("nth"))).alias("b")
    )
    return picked.select("query_id", F.col("b.player").alias("reference"), F.col("b.gram").alias("segment"), F.lit("scan").alias("step"))


def reference_names(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(query_id, reference, segment, step)`` by steps A, B and C in turn."""
    names = profiles.where(F.col("player").isNotNull()).select("row_id", "player")
    asked = requests.select("query_id", F.lower("query").alias("text"))
    a = cut_lineage(mentioned_names(asked, names))
    rest = asked.join(shuffled(a), "query_id", "left_anti")
    b = cut_lineage(cued_names(rest, names))
    c = scanned_names(rest.join(shuffled(b), "query_id", "left_anti"), names)
    return reduce(DataFrame.unionByName, [a, b, c])


def parse_requests(requests: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """All criteria of every request; without profiles no reference name is sought.

    A column ``chosen`` names the reference beside the text; where it is given, the text is not
    searched for one (``step`` is then ``chosen``).
    """
    text = F.lower("query")
    if profiles is None:
        named = requests.withColumns({c: F.lit(None).cast("string") for c in ["reference", "segment", "step"]})
    else:
        open_requests = requests.where("chosen IS NULL") if "chosen" in requests.columns else requests
        named = requests.join(shuffled(reference_names(open_requests, profiles)), "query_id", "left")
    if "chosen" in requests.columns:
        given = {"reference": F.col("chosen"), "segment": F.lower("chosen"), "step": F.lit("chosen")}
        named = named.withColumns({c: F.when(F.col("chosen").isNotNull(), value).otherwise(F.col(c)) for c, value in given.items()})
    parsed = named.withColumns(
        {
            "budget": budget(text),
            "position": position(text),
            "wants_flag": wants_flag(text),
            "style": style_text(text, F.col("reference"), F.col("segment")),
        }
    )
    route = (
        F.when(F.col("reference").isNotNull() & F.col("budget").isNotNull(), "reference_budget")
        .when(F.col("reference").isNotNull(), "reference")
        .when((F.col("style") != "") | F.col("wants_flag"), "description")
        .otherwise("none")
    )
    return parsed.withColumn("route", route)


# -------------------------------------------------------------------- answering


def answer_requests(
    parsed: DataFrame,
    profiles: DataFrame,
    weights: R.Weights,
    text_col: str,
    encode_style,
    shown: int = 5,
) -> DataFrame:
    """Ranked profiles of every parsed request, whatever its route.

    ``encode_style`` adds the vector ``text_col`` to a frame with ``profile``.
    Rows after the first cut are filtered, not refilled, and keep their rank
    unless the style text re-ranks them.  An array ``countries`` of labels or
    codes selects last, before the first ``shown`` are shown; empty or NULL
    keeps all, as do profiles without a nation column.
    """
    nation = detect_col(profiles, ["nation", "nationality_tm"])
    selects = nation is not None and "countries" in parsed.columns
    columns = ["player", "pos", "is_world_cup", *([nation] if selects else [])]
    names = profiles.groupBy(F.lower("player").alias("name_key")).agg(F.max("row_id").alias("row_id"))
    # Style of a reference request, else the description with its fixed default.
    wording = F.when(F.col("style") != "", F.col("style")).when(F.col("route") == "description", K.DEFAULT_DESCRIPTION)
    styled = cut_lineage(
        encode_style(parsed.select("query_id", wording.alias("profile")).where(F.col("profile").isNotNull())).select("query_id", text_col)
    )

    by_name = parsed.where(F.startswith("route", F.lit("reference"))).withColumn("name_key", F.lower("reference"))
    asked = by_name.join(shuffled(names), "name_key").select("query_id", "row_id", "budget", "position", "wants_flag", "route")
    grouped = profiles.withColumn("pos_group", broad_group(F.coalesce("pos", F.lit(""))))
    block = R.with_query_profile(asked, grouped, [*weights, "pos_group"])
    with_budget = F.col("budget").isNotNull()
    block = block.withColumns(
        {
            "exclude_row_id": F.col("row_id"),
            "max_value": F.col("budget"),
            "want_group": F.when(with_budget & F.col("position").isNotNull(), F.col("pos_group")),
            "want_pos": F.when(~with_budget, F.col("position")),
        }
    )
    cut = cut_lineage(R.describe(R.nearest(grouped, block, weights, 25, nulls_pass=True), profiles, columns))
    cut = cut.join(shuffled(asked.select("query_id", "budget", F.col("position").alias("asked_position"), "wants_flag")), "query_id")
    kept = cut.where(
        (F.col("budget").isNull() | F.col("asked_position").isNull() | contains_code(F.col("pos"), F.col("asked_position")))
        & (~F.col("wants_flag") | (F.col("is_world_cup") == 1))
    ).select("query_id", "rank", "row_id", "similarity", *columns)
    scores = R.pair_scores(kept.select("query_id", "row_id"), styled, profiles, text_col, numpy_cosine("q_vec", "c_vec"))
    restyled = R.blend_rerank(kept.join(shuffled(styled.select("query_id")), "query_id", "left_semi"), scores, TEXT_SHARE)
    plain = kept.join(shuffled(styled.select("query_id")), "query_id", "left_anti")

    described = parsed.where(F.col("route") == "description").join(shuffled(styled), "query_id").select(
        "query_id", text_col, F.col("position").alias("want_pos"), F.col("budget").alias("max_value"), F.col("wants_flag").alias("want_flag")
    )
    found = R.description_search(profiles, described, text_col, 10, columns)
    result = ["query_id", "rank", "row_id", "similarity", *columns]
    stacked = reduce(DataFrame.unionByName, [x.select(*result) for x in (restyled, plain, found)])
    keep = F.lit(True)
    if selects:
        stacked = stacked.join(shuffled(parsed.select("query_id", F.transform("countries", label_to_code).alias("_codes"))), "query_id")
        keep = (F.coalesce(F.size("_codes"), F.lit(0)) <= 0) | F.coalesce(F.array_contains("_codes", F.upper(nation)), F.lit(False))
    return R.first_shown(stacked, keep, shown).select(*result)
