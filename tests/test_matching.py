"""Kernels and pruned joins against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred.functions import fuzzy
from kindred.functions.vectors import cosine
from kindred.operators import blocks, linkage
from kindred.operators import retrieval as R

WORDS = st.text(alphabet="abcdeé '-", max_size=70)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), min_size=1, max_size=8))
def test_lcs_kernels(pairs):
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    expected = [plain_lcs(a, b) for a, b in pairs]
    assert [fuzzy.lcs_length(a, b) for a, b in pairs] == expected
    assert fuzzy.lcs_lengths(left, right).tolist() == expected


def test_known_ratios():
    assert fuzzy.ratio("abc", "abd") == pytest.approx(200 * 2 / 6)
    assert fuzzy.token_sort("son heung-min", "heung-min son") == 100.0
    assert fuzzy.token_set("a b", "a b c") == 100.0
    assert fuzzy.partial("messi", "lionel messi") == 100.0
    assert fuzzy.weighted("messi", "lionel messi") == pytest.approx(90.0)


def spoil(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text) + 1)
        text = text[:at] + rng.choice(["", "x", "ab"]) + text[at + rng.randint(0, 1):]
    return text


@pytest.mark.parametrize("threshold", [85.0, 90.0, 97.0])
def test_best_sorted_matches_equals_brute_force(spark, threshold):
    rng = random.Random(int(threshold))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    right = sorted({" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(120)} | {"", "a"})
    left = sorted({spoil(rng, rng.choice(right), rng.randint(0, 5)).strip() for _ in range(150)} | {"zz", "a"})
    found = linkage.best_sorted_matches(
        spark.createDataFrame([(x,) for x in left], "l_key string"),
        spark.createDataFrame([(x, i) for i, x in enumerate(right)], "r_key string, ord long"),
        threshold,
    )
    got = {r.l_key: (r.r_key, round(r.score, 9)) for r in found.collect()}
    expected = {}
    for x in left:
        score, _, name = max((fuzzy.token_sort(x, y), -i, y) for i, y in enumerate(right))
        if score >= threshold:
            expected[x] = (name, round(score, 9))
    assert got == expected


def test_common_segments_lose_no_pair(spark):
    rng = random.Random(4)
    clubs = ["manchester city", "real"]
    right = sorted({"".join(rng.choice("abcdefgh") for _ in range(14)) + " " + rng.choice(clubs) for _ in range(80)})
    left = sorted({spoil(rng, rng.choice(right), 1).strip() for _ in range(80)})
    l_df = spark.createDataFrame([(x,) for x in left], "l_text string")
    r_df = spark.createDataFrame([(x,) for x in right], "r_text string")
    got = {(r.l_text, r.r_text) for r in linkage.near_pairs(l_df, r_df, 95.0).collect()}
    assert got == {(x, y) for x in left for y in right if fuzzy.ratio(x, y) >= 95.0}


def test_weighted_best_match_equals_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 7)))
    names = sorted({" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(90)})
    asked = sorted({" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(60)} | {"ab  ab"})
    found = linkage.best_fuzzy(
        spark.createDataFrame(list(enumerate(asked)), "query_id long, text string"),
        spark.createDataFrame(list(enumerate(names)), "row_id long, text string"),
        55.0,
    )
    got = {r.query_id: (r.row_id, round(r.score, 9)) for r in found.collect()}
    expected = {}
    for i, x in enumerate(asked):
        score, j = max((fuzzy.weighted(x, y), -j) for j, y in enumerate(names))
        if score >= 55.0:
            expected[i] = (-j, round(score, 9))
    assert got == expected


def test_fuzzy_join_cascade(spark):
    left = spark.createDataFrame(
        [(0, "Vinícius Júnior", "Real"), (1, "Heung-min Son", "Spurs"), (2, "Ann Other", "X"), (3, "Vinicius Junior", "Real"), (4, None, None),
         (5, "Bernardo Silvestre", "Far away club")],
        "row_id long, player string, squad string",
    )
    right = spark.createDataFrame(
        [(0, "Vinicius Junior", "Real", 1.0), (1, "Son Heung-min", "Spurs", 2.0), (2, "vinicius junior", "real", 3.0),
         (3, "Bernardo Silvestre", "Q", 4.0)],
        "row_id long, player string, squad string, market_value_eur double",
    )
    out = {r.row_id: r for r in linkage.fuzzy_join(left, right).collect()}
    assert len(out) == 6
    # Equal right keys: the last row carries the data; two left rows may share one right row.
    assert out[0].market_value_eur == 3.0 and out[3].market_value_eur == 3.0 and out[0].match_strategy == "full_key"
    assert out[1].market_value_eur == 2.0 and out[1].match_score == 100.0
    assert out[2].match_strategy == "no_match" and out[2].market_value_eur is None
    assert out[5].match_strategy == "name_only" and out[5].match_score == 100.0


def test_resolve_names_stages(spark):
    names = spark.createDataFrame(
        [(0, "Lionel Messi"), (1, "Rodri"), (2, "Pedri"), (3, "rodri"), (4, "Rodrigo Goes")], "row_id long, player string"
    )
    asked = ["RODRI ", "odr", "mesi", "lionell mesi", "", "qqqqq"]
    found = linkage.resolve_names(spark.createDataFrame(list(enumerate(asked)), "query_id long, query string"), names)
    got = {r.query_id: (r.stage, r.row_id) for r in found.collect()}
    assert got[0] == ("exact", 3)
    assert got[1] == ("contained", 3)
    assert got[2] == ("fuzzy_last_name", 0)
    assert got[3][1] == 0
    assert got[4] == ("contained", 0)
    assert got[5] == ("not_found", None)


def test_align_benchmark(spark):
    names = spark.createDataFrame([(0, "Erling Haaland"), (1, "Harry Kane"), (2, "Robert Lewandowski")], "row_id long, player string")
    curated = spark.createDataFrame(
        [("Erling Halland", "nobody like this one", 1), ("Erling Halland", "Erling Haaland", 2), ("Erling Halland", "Hary Kane", 3),
         ("Erling Halland", "Robert Lewandowsky", 4), ("unknownperson", "Harry Kane", 1)],
        "query string, similar string, ord int",
    )
    rows = [tuple(r) for r in linkage.align_benchmark(curated, names).orderBy("tm_rank").collect()]
    assert rows == [
        ("Erling Halland", "Erling Haaland", "Harry Kane", 1), ("Erling Halland", "Erling Haaland", "Robert Lewandowski", 2),
    ]


# --------------------------------------------------------------------- retrieval


@pytest.fixture(scope="module")
def profiles(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        v = rng.normal(size=6).round(1)
        v = v if i % 7 else np.zeros(6)
        # Every third vector repeats the one before it, so exact ties occur.
        v = np.array(rows[-1][4]) if i % 3 == 2 else v
        rows.append((i, f"p{i}", ["GK", "CB", "ST", None][i % 4], None if i % 5 == 0 else float(i), [float(x) for x in v], i % 2))
    return spark.createDataFrame(
        rows, "row_id long, player string, pos string, market_value_eur double, vec array<double>, is_world_cup int"
    ).repartition(5).cache()


def brute(profiles, k, keep=None):
    from pyspark.sql import Window

    q = profiles.select(F.col("row_id").alias("query_id"), F.col("vec").alias("qv"), F.col("pos").alias("q_pos"))
    pairs = q.join(profiles, F.col("query_id") != F.col("row_id"))
    pairs = pairs if keep is None else pairs.where(keep)
    scored = pairs.withColumn("score", F.round(cosine(F.col("qv"), F.col("vec")), 12))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "row_id")
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return {(r.query_id, r.rank): r.row_id for r in ranked.collect()}


def test_block_search_equals_pairwise_search(spark, profiles, monkeypatch):
    monkeypatch.setattr(blocks, "CANDIDATE_BLOCK_ROWS", 32)
    monkeypatch.setattr(blocks, "QUERY_BLOCK_ROWS", 50)
    monkeypatch.setattr(blocks, "RUNNING_ROWS", 400)
    asked = profiles.select(F.col("row_id").alias("query_id"), "row_id")
    found = R.find_similar(profiles, asked, {"vec": 1.0}, k=4)
    assert {(r.query_id, r.rank): r.row_id for r in found.collect()} == brute(profiles, 4)


def test_per_query_position_and_budget(spark, profiles):
    asked = profiles.where("pos is not null").select(F.col("row_id").alias("query_id"), "row_id", F.col("pos").alias("want_pos"))
    found = R.find_similar(profiles, asked, {"vec": 1.0}, k=3)
    expected = brute(profiles.where("pos is not null"), 3, F.col("q_pos") == F.col("pos"))
    assert {(r.query_id, r.rank): r.row_id for r in found.collect()} == expected
    budget = profiles.select(F.col("row_id").alias("query_id"), "row_id", F.lit(50.0).alias("budget"))
    found = R.find_budget_replacement(profiles, budget, {"vec": 1.0}, k=3, same_position=False)
    within = F.coalesce(F.col("market_value_eur") <= 50, F.lit(True))
    assert {(r.query_id, r.rank): r.row_id for r in found.collect()} == brute(profiles, 3, within)


def test_blend_by_blocks_equals_joined_vectors(spark, profiles):
    from kindred.functions.vectors import blend
    from kindred.operators.features import unit_blocks

    halves = profiles.withColumns({"stat": F.slice("vec", 1, 3), "text": F.slice("vec", 4, 3)})
    joined = halves.withColumn("vec", blend(F.col("stat"), F.col("text"), 0.3))
    asked = profiles.select(F.col("row_id").alias("query_id"), "row_id")
    by_blocks = R.find_similar(unit_blocks(halves, ["stat", "text"]), asked, R.stat_text_weights(0.3), k=3)
    assert {(r.query_id, r.rank): r.row_id for r in by_blocks.collect()} == brute(joined, 3)


def test_gems_need_a_value_and_a_similarity(spark, profiles):
    targets = spark.createDataFrame([(1, "ST", 1000.0)], "query_id long, position string, max_value double")
    found = R.find_hidden_gems(profiles, targets, {"vec": 1.0}, min_similarity=-1.0, k=500, columns=["pos", "market_value_eur"]).collect()
    assert found and all(r.market_value_eur is not None and r.pos == "ST" for r in found)
    assert R.find_hidden_gems(profiles, targets, {"vec": 1.0}, min_similarity=1.1, k=5).count() == 0


def test_filters_after_the_cut_keep_ranks(spark):
    cut = spark.createDataFrame(
        [(1, 1, 10, 0.9, 0), (1, 2, 11, 0.8, 1), (1, 3, 12, 0.7, 1)], "query_id long, rank int, row_id long, similarity double, is_world_cup int"
    )
    shown = R.first_shown(cut, F.col("is_world_cup") == 1, 1)
    assert [(r.rank, r.row_id) for r in shown.collect()] == [(2, 11)]
    scores = spark.createDataFrame([(1, 12, 1.0)], "query_id long, row_id long, text_score double")
    again = [(r.rank, r.row_id, r.similarity) for r in R.blend_rerank(cut, scores).orderBy("rank").collect()]
    assert again == [(1, 10, 0.9), (2, 12, 0.82), (3, 11, 0.8)]


def test_containing_names_equal_plain(spark):
    rng = random.Random(9)
    letters = "aab é😀"
    names = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))) for i in range(150)] + [(500, "a" * 30)]
    asked = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(80)] + ["a", "a", "aa", "zz", "z", "a" * 31, None]
    asked += [n[k : k + 9] for _, n in names[:40] for k in (0, 3)]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, text string")
    dimension = spark.createDataFrame(names, "ord long, name string")
    found = linkage.containing_names(queries, dimension)
    expected = {}
    for q, text in enumerate(asked):
        hits = [o for o, n in names if text and text in n]
        if hits:
            expected[q] = (min(hits), len(hits))
    assert {r["query_id"]: (r["ord"], r["hits"]) for r in found.collect()} == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" not in plan and "contains(" not in plan
    assert linkage.containing_names(queries.limit(0), dimension).count() == linkage.containing_names(queries, dimension.limit(0)).count() == 0


def test_near_texts_are_settled_before_the_block_join(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    names = [f"{word(10)} {word(12)}" for _ in range(60)]
    names += names[:5] + ["aa bb", "", "abab"]
    asked = [x[:6] + x[7:] for x in names[:50]] + ["aa bb", "", "bb aa", names[0][11:], "zzz"]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id long, text string")
    n = spark.createDataFrame(list(enumerate(names)), "row_id long, text string")
    expected = {}
    for i, x in enumerate(asked):
        score, j = max((fuzzy.weighted(x, y), -j) for j, y in enumerate(names))
        if score >= 55.0:
            expected[i] = (-j, round(score, 9))
    open_texts, block_join = [], linkage.best_fuzzy
    monkeypatch.setattr(linkage, "best_fuzzy", lambda q, *rest: open_texts.extend(r["text"] for r in q.collect()) or block_join(q, *rest))
    assert {r.query_id: (r.row_id, round(r.score, 9)) for r in linkage.best_blended(q, n, 55.0).collect()} == expected
    assert sorted(open_texts) == sorted(x for x in asked if max(fuzzy.ratio(x, y) if x and y else 0 for y in names) <= 95.0)


def test_requests_with_a_near_name_compare_nothing_else(spark, monkeypatch):
    from kindred.operators import requests as Q

    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("bcdfghjk") for _ in range(n))
    people = [f"{word(9)} {word(12)}" for _ in range(30)]
    profiles = spark.createDataFrame(list(enumerate(people)), "row_id long, player string")
    typo = lambda x: x[:13] + x[14:]
    asked = [(i, f"get me {typo(x).split()[1]} now") for i, x in enumerate(people[:10])]
    asked += [(20 + i, f"someone like {x[:4] + x[5:]}e") for i, x in enumerate(people[:10])]
    met, block_join = [], Q.best_fuzzy
    monkeypatch.setattr(Q, "best_fuzzy", lambda q, *rest: met.append(q.count()) or block_join(q, *rest))
    found = Q.reference_names(spark.createDataFrame(asked, "query_id long, query string"), profiles).collect()
    assert {r.query_id: (r.reference, r.step) for r in found} == {i: (people[i % 20], "scan" if i < 20 else "cue") for i, _ in asked}
    assert sum(met) == 0


def test_joins_on_derived_texts_are_not_broadcast(spark, tmp_path):
    rows = [(i, f"first{i} last{i}", "club", float(i)) for i in range(50)]
    path = str(tmp_path / "people")
    spark.createDataFrame(rows, "row_id long, player string, squad string, market_value_eur double").write.parquet(path)
    people = spark.read.parquet(path)  # so small that Spark would broadcast whatever comes of it
    asked = people.selectExpr("row_id AS query_id", "substr(player, 3, 6) AS query")
    keys = r"BroadcastHashJoin \[(?!head)\w+#"  # heads of the asked texts are an aggregate
    for df in (linkage.lookup_profiles(asked, people), linkage.fuzzy_join(people, people)):
        assert not re.search(keys, df._jdf.queryExecution().executedPlan().toString())
