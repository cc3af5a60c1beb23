import random

import pytest


@pytest.fixture(scope="session")
def nasty(spark):
    """Documents with NULLs, blanks, a very long text, ties, repeated rows and clashing extra columns."""
    rng = random.Random(3)
    words = ["the", "Of", "licença", "日本語", "under", "mit", "license", "x!!", "$$$", "Ünï_x", "a"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = "\n".join(text(14) for _ in range(9))
    rows = [
        (0, None, "s1"), (1, "", "s1"), (2, " \t\n\x0b ", None), (3, text(80), "s2"), (3, text(70), "s2"), (4, passage, "s1"),
        (5, text(5) + "\n" + passage + "\n" + text(9), None), (6, passage, "s3"), (7, text(60_000), "s3"), (8, "y" * 50_000, ""),
        (9, "same row of words " * 20, "s1"), (9, "same row of words " * 20, "s1"), (None, text(90), "s2"), (None, None, None),
        (10, "Released under the MIT License.\r\nLicensed under the Apache License, Version 2.0. CC BY-NC", "s4"),
    ]
    rows += [(20 + i, text(rng.randint(0, 120)), f"s{i % 4}") for i in range(40)]
    return spark.createDataFrame(
        [(i, t, "en", s, 0 if t is None else len(t), "own", 7, [1]) for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score string, _t int, draws array<int>",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, score string, _t int, draws array<int>")
