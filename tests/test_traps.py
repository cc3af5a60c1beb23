"""Small hand-made frames, one per semantic trap."""

import math

import pytest
from pyspark.sql import functions as F

from kindred.functions import text as X
from kindred.functions.columns import as_double, clean_name, detect_col
from kindred.functions.positions import broad_group, contains_code, evaluation_group
from kindred.functions.vectors import blend, cosine, l2_normalise
from kindred.operators import features as E
from kindred.operators import filters as W
from kindred.operators import quality as Q
from kindred.operators.metrics import ideal_gain, ranking_metrics
from kindred.operators.quantiles import exact_quantiles
from kindred.operators.radar import radar_profiles
from kindred.operators.requests import parse_requests
from kindred.operators.squads import append_squads


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_feature_matrix_fills_and_keeps_constant_columns_at_zero(spark):
    df = spark.createDataFrame([("1", 5.0), ("3", 5.0), ("bad", 5.0)], "a string, b double")
    features = ["a", "b", "absent"]
    scaled = E.standardise(df, E.feature_moments(df, features), features)
    rows = sorted(r["scaled"][0] for r in scaled.collect())
    mean, spread = 4 / 3, math.sqrt(((1 - 4 / 3) ** 2 + (3 - 4 / 3) ** 2 + (4 / 3) ** 2) / 3)
    assert rows == pytest.approx(sorted((v - mean) / spread for v in (1, 3, 0)))
    assert all(r["scaled"][1:] == [0.0, 0.0] for r in scaled.collect())


def test_population_spread(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    scaled = E.standardise(df, E.feature_moments(df, ["a"]), ["a"])
    assert sorted(r["scaled"][0] for r in scaled.collect()) == [-1.0, 1.0]


def test_pca_components_are_clamped_and_reloadable(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i * i % 7), float(i % 3)) for i in range(20)], "a double, b double, c double")
    names = ["a", "b", "c"]
    moments = E.feature_moments(df, names)
    scaled = E.standardise(df, moments, names)
    pca = E.fit_pca(scaled, 32, len(scaled.first()["scaled"]))
    assert pca.getK() == 3
    assert sum(pca.explainedVariance) == pytest.approx(1.0)
    E.save_embedder(moments, pca, str(tmp_path))
    again = E.transform_rows(df, *E.load_embedder(spark, str(tmp_path)), names)
    direct = E.apply_pca(scaled, pca)
    a, b = (sorted(tuple(r["stat"]) for r in d.collect()) for d in (again, direct))
    assert a == [pytest.approx(x) for x in b]


def test_null_value_passes_budget_and_fails_cap(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 5.0), (4, 6.0), (5, 7.0)], "i int, v double")
    v = F.col("v")
    assert [r.i for r in df.where(W.within_budget(v, 6.0)).orderBy("i").collect()] == [1, 2, 3, 4]
    assert [r.i for r in df.where(W.value_cap(v, 6.0)).orderBy("i").collect()] == [3, 4]


def test_position_groups(spark):
    codes = ["GK", "CB", "LWB", "RWB", "DM", "AM", "LW", "ST", "FW", "DF", "MF", "DF,MF", None, "cb"]
    df = spark.createDataFrame([(c,) for c in codes], "pos string")
    rows = df.select("pos", broad_group(F.coalesce("pos", F.lit(""))), evaluation_group(F.col("pos")), contains_code(F.col("pos"), "b")).collect()
    assert [r[1] for r in rows] == ["GK", "DEF", "DEF", "DEF", "MID", "MID", "FWD", "FWD", "FWD", "UNK", "UNK", "UNK", "UNK", "DEF"]
    assert [r[2] for r in rows] == [
        "GK", "CB", "Winger", "Winger", "CDM", "CAM", "Winger", "Striker", "Striker", None, None, None, None, "CB",
    ]
    assert rows[12][3] is False and rows[13][3] is True


def test_metrics_edges(spark):
    queries = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "query_id int, n_relevant int")
    # Query 3 retrieves the same relevant name twice: one distinct hit, two list positions.
    hits = spark.createDataFrame([(1, 2, "a"), (3, 1, "b"), (3, 2, "b")], "query_id int, rank int, item string")
    found = {(r.query_id, r.k): r for r in ranking_metrics(queries, hits, [0, 2], ["query_id"]).collect()}
    assert found[1, 2].precision_at_k == 0.5 and found[1, 2].recall_at_k == 0.5
    assert found[1, 2].ndcg_at_k == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)))
    assert found[2, 2].ndcg_at_k == 0.0 and found[2, 2].recall_at_k == 0.0
    assert found[3, 2].precision_at_k == 0.5 and found[3, 2].ndcg_at_k > 1.0
    assert found[1, 0].precision_at_k == 0.0 and found[1, 0].f1_at_k == 0.0


def test_ideal_gain_of_nothing_is_zero(spark):
    assert one(spark, ideal_gain(F.lit(0), F.lit(5))) == 0.0


@pytest.mark.parametrize(
    "raw, value",
    [("€85m", 85e6), ("€4.50m", 4.5e6), ("€850k", 850e3), ("€1.2bn", 1.2e9), ("€4,5m", 4.5e6), ("-", None), ("?", None), ("", None),
     ("free transfer", None), ("1.2.3", None), (None, None)],
)
def test_money(spark, raw, value):
    found = one(spark, X.parse_money(F.lit(raw).cast("string")))
    assert found == (pytest.approx(value) if value is not None else None)


@pytest.mark.parametrize("value, shown", [(None, "N/A"), (25e6, "€25.0M"), (850_000.0, "€850K"), (999.0, "€999")])
def test_money_text(spark, value, shown):
    assert one(spark, X.format_money(F.lit(value).cast("double"))) == shown


def test_name_folding(spark):
    df = spark.createDataFrame([("Vinícius Júnior ",), ("Søren",), ("",), (None,), ("Ødegaard-Ł",)], "n string")
    rows = df.select(X.fold_name("n"), X.fold_plain(F.col("n"))).collect()
    assert [r[0] for r in rows] == ["vinicius junior", "søren", "", "", "ødegaard-ł"]
    assert [r[1] for r in rows][:2] == ["vinicius junior", "s ren"]


def test_sorted_tokens(spark):
    assert one(spark, X.sorted_tokens(F.lit("  Son  Heung-min "))) == "Heung-min Son"


def test_search_variants_and_scores(spark):
    df = spark.createDataFrame([("Neymar Silva Jr.",), ("Pelé",), ("Ana Ana",)], "n string").withColumn("p", X.fold_plain(F.col("n")))
    rows = [r[0] for r in df.select(X.search_variants(F.col("n"), F.col("p"))).collect()]
    assert rows[0] == ["Neymar Silva Jr.", "Jr.", "Neymar", "Neymar Jr.", "neymar silva jr", "Neymar Silva"]
    assert rows[1] == ["Pelé"]
    assert rows[2] == ["Ana Ana", "Ana"]
    score = lambda a, b: one(spark, X.token_name_score(F.lit(a), F.lit(b)))
    assert score("a b", "a b") == 1.0
    assert score("a b", "a b c") == 0.75
    assert score("x b", "y b") == pytest.approx(0.70)
    assert score("", "a") == 0.0
    assert score("a b", "b a c d") == pytest.approx(0.5)


def test_addresses_and_labels(spark):
    assert one(spark, X.slug(F.lit("Ángel Di  María-7"))) == "ngel_di_mar_a-7"
    assert one(spark, X.image_extension(F.lit("http://x/a.b.WEBP?s=1"))) == "webp"
    assert one(spark, X.image_extension(F.lit("nodot"))) == "jpg"
    assert one(spark, X.strip_markers(F.lit("Ann Lee (captain) [2]"))) == "Ann Lee"
    assert one(spark, X.feature_label(F.lit("tkl_w_per90"))) == "Tkl W/90"
    assert one(spark, X.flag_key(F.lit("zzz"))) == "un" and one(spark, X.flag_key(F.lit("N/A"))) == ""
    assert one(spark, X.label_to_code(F.lit("England 🏴󠁧󠁢󠁥󠁮󠁧󠁿"))) == "ENG" and one(spark, X.label_to_code(F.lit("bra"))) == "BRA"
    assert [one(spark, X.similarity_band(F.lit(s))) for s in (0.82, 0.65, 0.1)] == ["high", "medium", "low"]
    assert one(spark, X.bar_band(F.lit(0.8))) == "medium"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(
        l2_normalise(F.col("a")).alias("u"), l2_normalise(F.col("b")).alias("z"), cosine(F.col("a"), F.col("b")).alias("c"),
        blend(F.col("a"), F.col("b"), 0.5).alias("m"),
    ).first()
    assert r.u == [0.6, 0.8] and r.z == [0.0, 0.0] and r.c == 0.0 and r.m == [0.3, 0.4, 0.0, 0.0]
    with pytest.raises(ValueError):
        blend(F.col("a"), F.col("b"), 1.5)


def test_transfer_dedup_and_threshold(spark):
    rows = [(1, "A", "L1", 900.0, 9), (2, "A", "L2", 900.0, 1), (3, "B", "L1", 449.0, 3), (4, "B", "L2", 450.0, 5), (5, "C", "L1", None, 2)]
    df = spark.createDataFrame(rows, "row_id long, player string, league string, min double, gls int")
    found = values(Q.clean_statistics(df).select("row_id", "player", "gls_per90"), "row_id")
    assert found == [(1, "A", 0.9), (4, "B", 1.0)]


def test_names_and_coercion(spark):
    assert clean_name("Unnamed: 0_level_0_Rk") == "0_rk"
    assert clean_name("Per 90 Minutes_G+A") == "per90_g+a"
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",)], "v string")
    assert [r[0] for r in df.select(as_double("v")).collect()] == [1.5, None, None]
    assert detect_col(df, ["w", "v"]) == "v" and detect_col(df, ["w"]) is None


def test_quantiles_interpolate_and_skip_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None), (None, None)], "a double, b double")
    found = {(r.feature, r.prob): r.quantile for r in exact_quantiles(df, ["a", "b"], [0.25, 0.95]).collect()}
    assert found["a", 0.25] == pytest.approx(1.5) and found["a", 0.95] == pytest.approx(9.2)
    assert found["b", 0.25] is None


def test_bracketed_quantiles_equal_the_sorted_answer(spark, monkeypatch):
    import numpy as np

    from kindred.operators import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", 500)
    monkeypatch.setattr(quantiles, "MARGIN", 10.0 / 500)
    numbers = np.round(np.random.default_rng(5).lognormal(size=20_000), 2)
    df = spark.createDataFrame([(float(x),) for x in numbers], "v double").repartition(4)
    found = {r.prob: r.quantile for r in exact_quantiles(df, ["v"], [0.05, 0.5, 0.95]).collect()}
    assert found == {p: pytest.approx(float(np.quantile(numbers, p))) for p in (0.05, 0.5, 0.95)}


@pytest.mark.parametrize("numbers", [[5.0], [1.0, 2.0], [1.0, 1.0, 1.0, 9.0], [float(i % 7) for i in range(50)]])
def test_quantiles_of_few_and_tied_values(spark, numbers):
    import numpy as np

    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    found = {r.prob: r.quantile for r in exact_quantiles(df, ["v"], probs).collect()}
    assert found == {p: pytest.approx(float(np.quantile(numbers, p))) for p in probs}


def test_missing_keys_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "row_id long, player string")
    assert values(Q.duplicate_rows(df, ["player"]).select("row_id"), "row_id") == [(1,), (2,), (3,), (4,)]


def test_shared_last_names_go_to_the_alphabetically_last_holder(spark):
    profiles = spark.createDataFrame([(0, "Zeta Silva"), (1, "Andre Silva"), (2, "Bernardo Silva")], "row_id long, player string")
    asked = spark.createDataFrame([(7, "get me silvaa now")], "query_id long, query string")
    assert parse_requests(asked, profiles).first()["reference"] == "Zeta Silva"


def test_a_cue_over_two_lines_is_taken_out_as_written(spark):
    profiles = spark.createDataFrame([(0, "Bernardo Costa"), (1, "Ann Other")], "row_id long, player string")
    asked = spark.createDataFrame([(1, "someone like bernado\nkosta")], "query_id long, query string")
    row = parse_requests(asked, profiles).first()
    assert (row["reference"], row["style"]) == ("Bernardo Costa", "someone")


def test_the_last_row_holds_a_shared_last_name(spark):
    from kindred.operators.linkage import resolve_names

    profiles = spark.createDataFrame([(0, "Ana Silvestre"), (1, "Bea Silvestre"), (2, "Ana Silvestre")], "row_id long, player string")
    asked = spark.createDataFrame([(1, "silvestrre")], "query_id long, query string")
    assert resolve_names(asked, profiles).first()["row_id"] == 2


def test_the_task_count_follows_the_setting(spark):
    from kindred.session import task_count

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert task_count(spark) == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 50.0), (3, "b", 20.0)], "row_id long, player string, age double")
    assert values(Q.missing_rates(df, ["age", "player"]), "column_name") == [("age", pytest.approx(100 / 3)), ("player", 0.0)]
    assert [r.column_name for r in Q.highly_missing(Q.missing_rates(df)).collect()] == ["age"]
    assert values(Q.duplicate_rows(df, ["player"]).select("row_id"), "row_id") == [(1,), (2,)]
    assert values(Q.bounds_violations(df), "column_name") == [("age", 1)]


def test_radar_keeps_missing_and_zero_top(spark):
    rows = [(i, f"p{i}", "ST", float(i) if i else None, 0.0) for i in range(5)]
    df = spark.createDataFrame(rows, "row_id long, player string, pos string, gls_per90 double, ast_per90 double")
    found = {r.row_id: r.radar for r in radar_profiles(df).collect()}
    assert found[0][0]["value"] is None and found[0][1]["value"] == 0.0
    assert found[4][0]["value"] == 1.0
    assert found[1][0]["average"] == pytest.approx(2.5 / 3.85)


def test_squads(spark):
    base = spark.createDataFrame(
        [(1, "Ann", "GK", 10.0, 80.0, 0), (2, "Bob", "MF", 20.0, 90.0, 0), (3, "Bob", "MF", 40.0, 90.0, 0)],
        "row_id long, player string, pos string, market_value_eur double, pass_completion_pct double, is_world_cup int",
    )
    squad = spark.createDataFrame([(1, " ann "), (2, "Cid"), (3, "cid ")], "row_id long, player string").withColumns(
        {"pos": F.lit("ZZ"), "nation": F.lit("BRA"), "squad": F.lit("S"), "nationality_tm": F.lit("Brazil")}
    )
    out = {r.player: r for r in append_squads(base, squad).collect()}
    assert set(out) == {"Ann", "Bob", "Cid"}
    assert out["Ann"].is_world_cup == 1 and out["Bob"].market_value_eur == 20.0
    assert out["Cid"].market_value_eur == pytest.approx(30.0 * 0.7) and out["Cid"].pass_completion_pct == 90.0
    assert out["Cid"].match_strategy == "wc2026_wiki"


@pytest.mark.parametrize(
    "query, expected",
    [
        ("striker like Erling Haaland under €80M", ("Erling Haaland", 80e6, "FW", False, "reference_budget")),
        ("under 30,000,000", (None, 30e6, None, False, "none")),
        ("fast winger under 30 million", (None, 30e6, "FW", False, "description")),
        ("playmaker like Mesi", ("Lionel Messi", None, "MF", False, "reference")),
        ("World Cup midfielder", (None, None, "MF", True, "description")),
        ("", (None, None, None, False, "none")),
    ],
)
def test_requests(spark, query, expected):
    names = spark.createDataFrame([(1, "Erling Haaland"), (2, "Lionel Messi"), (3, "Rodri")], "row_id long, player string")
    asked = spark.createDataFrame([(1, query)], "query_id long, query string")
    # Without names for the requests that mention none: a scan of all word runs may find a weak match.
    parsed = parse_requests(asked, names if expected[0] else None).first()
    assert (parsed.reference, parsed.budget, parsed.position, parsed.wants_flag, parsed.route) == expected


def test_chosen_reference_is_not_searched_for(spark):
    people = spark.createDataFrame([(1, "Zeta Silva"), (2, "Ana Costa")], "row_id long, player string")
    asked = spark.createDataFrame(
        [(1, "quick like Ana Costa", "Zeta Silva"), (2, "quick like Ana Costa", None)], "query_id long, query string, chosen string"
    )
    found = {r["query_id"]: (r["reference"], r["step"]) for r in parse_requests(asked, people).collect()}
    assert found == {1: ("Zeta Silva", "chosen"), 2: ("Ana Costa", "mention")}
