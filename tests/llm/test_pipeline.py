"""The pipeline's stages one after the other, on a small table with planted cases."""

import random

import corpus_pipeline as P
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    line = lambda: " ".join(rng.choice(words) for _ in range(12))
    text = lambda n=9: "\n".join(line() for _ in range(n))
    rows = {i: text() for i in range(30)}
    passage = text(6)
    rows |= {100: f"{text()}\n{passage}\n{text()}", 101: f"{text()}\n{passage}\n{text()}"}
    rows |= {200: rows[4], 201: rows[5].replace("\n", " ")}  # an exact copy, and one without its lines
    rows |= {300: None, 301: "", 302: "too short", 303: "again and again " * 80}
    docs = [(i, t, "en", f"s{i % 2}", None if t is None else len(t)) for i, t in rows.items()]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 30, 2)] + [(303, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, passage


def test_stages_hand_over_what_they_keep(spark, folder):
    path, rows, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumns({"score": F.lit("own"), "_t": F.lit(7)})
    columns, texts = docs.columns, [rows]
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, path).persist()
        assert docs.columns == columns
        assert {(r["score"], r["_t"]) for r in docs.select("score", "_t").distinct().collect()} == {("own", 7)}
        texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    good, fresh, single, mixed = texts[1:]
    assert good == {i: t for i, t in rows.items() if i < 300}
    assert set(fresh) == set(good) - {200}  # its lines all stand in document 4
    assert passage in fresh[100] and not any(x in fresh[101] for x in passage.split("\n"))
    assert set(single) == set(fresh) - {201} and all(single[i] == fresh[i] for i in single)
    assert mixed and set(mixed) <= set(single) and all(set(t.split()) <= set(single[i].split()) for i, t in mixed.items())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    encoded = P.STAGES[-1][1](spark, docs, path).collect()
    expected = sorted((r["doc_id"], len(library.encode(r["text"], add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in encoded) == expected


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    assert all(stage(spark, docs, folder[0]).count() == 0 for _, stage in P.STAGES)
