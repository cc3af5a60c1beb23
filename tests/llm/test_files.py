"""Tokens, archives and licences: library equality, round trips and plain scans."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import bpe, warc
from kindred.llm import license_scan as N
from kindred.llm import token_ids as K

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(1)
    signs = "abcdefgh ijklmnop QRSTÉéßœ日本語😀ΑΣς123'<|endoftext|>\t\n\x0b\x0c\r\x1c\x1f\x85\xa0 　​!?-_.,'s'll éİ́"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    names = list(library(WORDS).get_vocab())
    texts += ["".join(rng.choice(names).replace("</w>", "") for _ in range(4)) for _ in range(1500)]
    return texts + ["<|startoftext|>hi<|endoftext|> there <|ENDOFTEXT|>", "a" * 3000, "haha" * 90, "ΑΣ ΑΣΑ Σ", "", " ", "\n\n x  "]


@pytest.fixture(scope="module")
def speculative():
    return bpe.SpeculativeBpe(WORDS)


def test_bpe_equals_the_library(speculative):
    texts, reference = odd_texts(), library(WORDS)
    for text, ids in zip(texts, speculative.encode(texts)):
        expected = reference.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert speculative.decode(ids) == reference.decode(expected, skip_special_tokens=False)


def test_bpe_worker_keeps_little_and_forgets_long_words(monkeypatch):
    """Memory of a worker (F1 of round 3): compact ids of a bounded number of words, none of a long one; freed memory goes back."""
    import tracemalloc

    encode, rng, returned = bpe.SpeculativeBpe(WORDS), random.Random(5), []
    spell = lambda: "".join(rng.choice("abcdeiou") for _ in range(9))
    encode.encode(["warm up"])
    tracemalloc.start()
    for _ in range(4):
        encode.encode([" ".join(f"{spell()}, {spell()}" for _ in range(10_000))])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 20e6  # 80,000 words; ids as lists took 25
    encode.encode(["z" * 300_000])
    small = [encode.cache.known, encode.cache.older, encode.words.known, encode.words.older]
    assert max(len(p) for known in small for p in known) <= 64
    monkeypatch.setattr(bpe, "give_back", lambda: returned.append(1))
    monkeypatch.setattr(bpe, "_MADE", {})
    bpe.encoder(WORDS)
    assert returned
    tiny = bpe.SpeculativeBpe(WORDS)
    tiny.words.most = tiny.cache.most = 20  # every generation is left soon
    texts = odd_texts()[::9]
    for text, ids in zip(texts, encode.encode(texts)):
        assert tiny.encode([text])[0].tolist() == ids.tolist()


def test_speculation_settles_words_and_sends_the_rest_to_merging(speculative, monkeypatch):
    merged = []
    monkeypatch.setattr(speculative, "_merge", lambda ids, real=speculative._merge: merged.append(1) or real(ids))
    words = ["the", "and", "information", "retrieval", "seren", "thnterblere"]
    for w in words:
        speculative._propose(w)
    merged.clear()
    speculative.encode_words(words)
    assert len(merged) < len(words)


def test_bpe_digests_of_documents(spark, nasty, no_docs):
    reference = library(WORDS)
    found = bpe.bpe_encode(nasty.withColumnRenamed("score", "ids_sha256"), WORDS).collect()
    expected = []
    for r in nasty.collect():
        ids = reference.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = reference.decode(ids, skip_special_tokens=False)
        expected.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert found[0]["_t"] == 7 and bpe.bpe_digests(no_docs, WORDS).count() == 0


def test_token_id_pieces_equal_the_library():
    texts, reference = odd_texts(), library(BYTES)
    for text, ids in zip(texts, K.encoder(BYTES)(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == reference.encode(text, add_special_tokens=False).ids, text


def test_token_id_shards_round_trip(nasty, no_docs):
    reference, manifest = library(BYTES), K.write_token_ids(nasty, BYTES)
    found = sorted(K.read_token_ids(manifest, 2, ids=True).collect(), key=lambda r: r["start"])
    rows = collections.Counter((r["doc_id"], tuple(reference.encode(r["text"] or "", add_special_tokens=False).ids + [2])) for r in nasty.collect())
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in found) == rows
    start = 0
    for r in found:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert order == sorted(order)
    assert K.read_token_ids(K.write_token_ids(no_docs, BYTES), 2).count() == 0


def test_a_short_document_is_read_alone_and_a_wrong_dictionary_is_refused(nasty):
    manifest = K.write_token_ids(nasty, BYTES).collect()
    with open(manifest[0]["dictionary"].removeprefix("file:"), "rb") as f:
        dictionary = f.read()
    shard = K.ShardReader(manifest[0]["path"], dictionary, 2)
    whole = list(shard)
    assert all((shard.document(i) == whole[i]).all() for i in range(len(whole)))
    with pytest.raises(ValueError, match="dictionary"):
        K.ShardReader(manifest[0]["path"], dictionary + b"x", 2)


PAGES = [
    (1, "http://www.Example.com:80/a?x=1#f", "p" * 200), (2, "https://example.com/a", "p" * 200), (3, "http://example.com/b", "short"),
    (4, "http://example.com/b", "short"), (5, None, None), (6, "", ""), (7, "http://[broken", "é" * 60), (8, "http://h:99/ü x", "é" * 60),
    (9, "http://example.com/b", "p" * 200), (1, "http://www.example.com/a?x=1", "p" * 200), (None, "http://example.com/z", "p" * 200),
    (None, "http://n/", "only null" * 20), (10, "http://big/", "w" * 300_000),
]


def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string")


def test_warc_round_trip(spark):
    df = pages(spark)
    captures, index = warc.archive(df)
    found = warc.read_records(warc.lookup(index, df), payloads=True).collect()
    first = {}
    for i, _, html in PAGES:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    expected = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        again = data in first and (i is None or i > first[data])
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None, b"" if again else data))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)) for r in found)
    assert captures.count() == len(PAGES)
    none = warc.archive(df.limit(0))
    assert warc.read_records(warc.lookup(none[1], df)).count() == 0


def test_index_looks_up_by_bisection_over_small_blocks(spark, tmp_path):
    df = pages(spark)
    captures, _ = warc.archive(df)
    rows = [("k%03d" % (i // 7), i, "p", i, 1) for i in range(5000)]
    lines = spark.createDataFrame(rows, warc.CAPTURES).coalesce(1)
    index = warc.write_index(lines, f"{tmp_path}/cdx")
    seen = []
    for part in index.collect():
        file = warc.IndexFile(part["path"])
        keys = sorted({f"k{i:03d}" for i in range(715)})
        for k in keys:
            seen += [(k, *x) for x in file.captures(k)]
    assert sorted(seen) == sorted(rows) and len(file.directory) >= 1


def test_url_keys():
    assert warc.url_key("https://User@WWW.Example.com:443/A/b?q=1#x") == "com,example,www)/A/b?q=1"
    assert warc.url_key("http://h:99") == "h:99)/"
    assert " " not in warc.url_key("http://h/a b\n") and warc.url_key(None) == ")/"


def plain_licences(text, idf):
    """Every template at every offset."""
    words, labels, starts, base, score = N.words_of(text), set(), [], set(), 0.0
    for phrase, label in N.BASE:
        p = phrase.encode().split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    score = 1.0 if starts else 0.0
    for label, text_, keys in N.TEMPLATES:
        t = text_.encode().split()
        rare = sorted(set(t), key=lambda w: (-idf[w], w))[: N.RARE]
        for o in range(-len(t), len(words)):
            agreed = {w for i, w in enumerate(t) if w in rare and 0 <= o + i < len(words) and words[o + i] == w}
            if len(agreed) < min(N.AGREE, len(rare)):
                continue
            ok = True
            for k in keys:
                k = k.encode().split()
                for p in (i for i in range(len(t)) if t[i : i + len(k)] == k):
                    ok &= any(words[i : i + len(k)] == k for i in range(max(0, o + p - N.SLACK), o + p + N.SLACK + 1))
            if ok:
                labels.add(label)
                held = sum(idf[w] for i, w in enumerate(t) if 0 <= o + i < len(words) and words[o + i] == w)
                score = max(score, held / sum(idf[w] for w in t))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), min(1.0, score)


def test_license_scan_equals_plain(spark, nasty, no_docs):
    rng = random.Random(2)
    rows = [r["text"] for r in nasty.where("length(text) < 3000 OR text IS NULL").collect()]
    for _, text, _ in N.TEMPLATES:
        rows += [f"intro, {text}! end", text.upper(), text[: len(text) // 2], re.sub(" the ", " some of the ", text)]
        words = text.split()
        words.insert(rng.randrange(len(words)), "extra")
        rows.append("Über " + " ".join(words))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    idf = N.word_idf(df)
    for r in N.license_scan(df).collect():
        got = tuple(r[c] for c in N.RESULTS)
        expected = plain_licences(r["text"], idf)
        assert got[:-1] == expected[:-1], r["text"]
        assert got[-1] == pytest.approx(expected[-1])
    assert N.license_scan(no_docs).count() == 0
    assert N.license_scan(nasty).where("n_base = 3").count() == 1
