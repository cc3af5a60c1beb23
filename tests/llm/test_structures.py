"""Alignment, toxicity and prefix trie against brute force, plain rules and held-out labels."""

import collections
import hashlib
import random
import zlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kindred.llm import alignment, prefix_trie, toxicity
from kindred.llm.pieces import by_ranks, byte_names, latin
from tests.llm.test_files import odd_texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def aligned_plainly(rows, libraries):
    """Rows of ``RESULTS`` from whole texts, token by token."""
    a_lib, b_lib = libraries
    names = byte_names(A)
    piece = lambda i: bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
    per_doc, held = [], collections.Counter()
    for doc_id, text in rows:
        per_doc.append((doc_id, None))
        if not text:
            continue
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        spelled, ends = (" " + text).encode(), []
        for side in ([names[i] for i in a], [piece(i) for i in b]):
            ends.append([])
            for x in side:
                ends[-1].append((ends[-1][-1] if ends[-1] else 0) + len(x))
            if b"".join(side) != spelled:
                break
        else:
            groups, i, j = [], 0, 0
            for end in sorted(set(ends[0]) & set(ends[1])):
                to_a, to_b = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
                groups.append((a[i:to_a], b[j:to_b]))
                i, j = to_a, to_b
            links = [(x, y) for left, right in groups for x in left for y in right]
            held.update(set(links))
            per_doc[-1] = (doc_id, (len(a), len(b), groups, links))
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for doc_id, found in per_doc:
        if not found:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        n_a, n_b, groups, links = found
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield doc_id, n_a, n_b, len(groups), len(links), sum(held[k] == most[k[0]] for k in links), sum(held[k] for k in links), text


def test_alignment_chunk_keeps_distinct_pieces_only(libraries, monkeypatch):
    """Memory of a chunk: not a string per word, nor all links of all documents at once."""
    import tracemalloc

    tool, words = alignment.Aligner(A, B), [f"wonderful{i}" for i in range(40)]
    texts = [" ".join(words[(d + i) % 40] for i in range(400)) for d in range(1000)]
    alignment._chunk(tool, [0], texts[:1])
    tracemalloc.start()
    _, pairs, counts = alignment._chunk(tool, list(range(1000)), texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # 400,000 words
    for pieces in (1, 700):
        monkeypatch.setattr(alignment, "SLICE_PIECES", pieces)
        _, again, n = alignment._chunk(tool, list(range(1000)), texts)
        assert again.tolist() == pairs.tolist() and n.tolist() == counts.tolist()


def test_alignment_equals_whole_texts(spark, nasty, no_docs, libraries, monkeypatch):
    odd = [t for t in odd_texts() if len(t) < 4000][::4] + ["a▁b", "x\ry \r\n z", "<s> <unk> <|endoftext|>", "\n\nlead", "tail  ", "\r", " ", "日本 語", "ﬁ Å"]
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()] + [(1000 + i, t) for i, t in enumerate(odd)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, chunk int").repartition(3)
    found = alignment.align_documents(docs, A, B)
    assert found.columns == alignment.RESULTS
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, aligned_plainly(rows, libraries)))
    assert alignment.align_documents(no_docs, A, B).count() == 0


def test_large_groups_and_many_chunks(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE_GROUP", 2)
    tool, texts = alignment.Aligner(A, B), ["hello wonderful world", "wonderful " * 9, "retrieval of informationé"]
    block, pairs, counts = alignment._chunk(tool, [1, 2, 3], texts)
    held = collections.Counter()
    a, b = libraries
    for row in aligned_plainly([(0, t) for t in texts], libraries):
        groups = [[list(map(int, side.split(","))) for side in g.split("|")] for g in row[-1].split(";")]
        held.update({x << 32 | y for left, right in groups for x in left for y in right})
    assert dict(zip(pairs.tolist(), counts.tolist())) == held and block


def test_ranks_equal_the_library(libraries):
    ranks = by_ranks(A)
    for text in odd_texts():
        if latin(text):
            assert ranks.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids, text


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(5)
    calm = ["river", "stone", "lamp", "window", "garden", "paper", "music", "number", "street", "winter", "summer", "quiet"]
    sour = ["grumbletok", "grumbleva", "grumblenix", "grumblera", "grumblesso"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [rng.choice(calm) + rng.choice("aeiou") * rng.randint(0, 2) for _ in range(rng.randint(20, 120))]
        if toxic:
            words[3:3] = rng.sample(sour, 3)
        rows.append((i, " ".join(words)))
        if i % 3 != 1:
            labels.append((i, int(toxic) if rng.random() > 0.03 else int(not toxic)))
    rows += [(None, None), (2000, ""), (2001, rows[0][1]), (2001, rows[0][1]), (2002, "x" * 60_000)]
    labels += [(None, 1), (5, None)]
    docs = spark.createDataFrame([(i, t, "old", 1) for i, t in rows], "doc_id long, text string, score string, bits int").repartition(4)
    found = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert set(found[0].asDict()) == {"doc_id", "bits", "held_out", "score", "predicted"} and len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None and r["doc_id"] < 900:
            assert r["predicted"] == (r["doc_id"] % 6 == 0), r
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    by_id = collections.defaultdict(set)
    for r in found:
        by_id[r["doc_id"]].add((r["score"], r["predicted"], r["held_out"]))
    assert all(len(x) == 1 for x in by_id.values()) and next(iter(by_id[2001]))[1] == 1
    assert next(iter(by_id[None]))[1:] == (0, False) and next(iter(by_id[2000]))[1] == 0


def test_toxicity_learns_only_from_its_folds(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, "snarglefoo snarglebar plain words here") for i in held] + [(1000, "you idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in held], "doc_id long, toxic int")
    assert {r["doc_id"] for r in toxicity.toxicity(docs, labels).collect() if r["predicted"]} == {1000}  # by the fixed lists
    none = spark.createDataFrame([], docs.schema)
    assert toxicity.toxicity(none, labels).count() == 0 and toxicity.toxicity(docs, labels.limit(0)).count() == len(held) + 1


def test_label_model_sees_through_noise_and_copies():
    rng, counts, truth = random.Random(2), collections.Counter(), collections.Counter()
    for _ in range(20_000):
        y = rng.random() < 0.2
        votes = [rng.random() < (0.8 if y else 0.05) for _ in range(4)]
        votes += [votes[0] if rng.random() < 0.95 else not votes[0]]  # a copy of the first voter
        bits = sum(v << j for j, v in enumerate(votes))
        label = -1 if rng.random() < 0.7 else int(y if rng.random() > 0.08 else not y)
        counts[bits, label] += 1
        truth[bits, label] += y
    model = toxicity.LabelModel(counts)
    assert any({0, 4} <= set(block) for block in model.blocks)
    assert abs(model.prior[1] - 0.2) < 0.02
    for key, n in counts.items():
        if n > 400:
            assert abs(model.post[key] - truth[key] / n) < 0.12, key


def trie_plainly(rows, family=100, heads=6):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = turns.get(c - c % family, [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    inner = {k[:-1] for k in members if k}
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in inner
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(rebuilt[c]) == len(k)))
        yield (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())


def conversations(rng):
    texts = ["hi", "", None, "ünï 日本", "yes", "no", "a much longer turn " * 30]
    rows = []
    for c in [*range(60), *range(100, 140), 250, 399, 1000, 1001, 1005]:
        for t in range(rng.choice([0, 1, 2, 4, 8])):
            rows.append((c, t or None, rng.choice(["user", "bot", None]), rng.choice(texts)))
    return rows


def test_trie_equals_plain_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 32)
    rng = random.Random(7)
    rows = conversations(rng)
    rows += [r for r in rows if r[0] == 7]  # repeated rows
    rows += [(c, t, "user", "same") for c in range(300, 380) for t in range(3)]  # equal conversations
    rows += [(500, t, "user", f"turn {t % 3}") for t in range(300)] + [(501, t, "user", f"turn {t % 3}") for t in range(200)]  # one conversation over many tasks
    rows += [(None, 0, "user", "nobody's"), (800, None, None, None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(5)
    found = prefix_trie.prefix_trie(df)
    assert found.columns == prefix_trie.RESULTS
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, trie_plainly(rows)))
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0


def test_trie_notices_equal_fingerprints_of_different_turns(spark, monkeypatch):
    rows = [(c, t, "user", f"text {c} {t}") for c in range(40) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(prefix_trie, "PRIME", 7)
    with pytest.raises(prefix_trie.Collision):
        prefix_trie.prefix_trie(df)
    monkeypatch.undo()
    calls = []
    real = prefix_trie.check_turns
    monkeypatch.setattr(prefix_trie, "check_turns", lambda t: calls.append(1) or (real(t) if len(calls) > 1 else (_ for _ in ()).throw(prefix_trie.Collision())))
    assert sorted(map(repr, map(tuple, prefix_trie.prefix_trie(df).collect()))) == sorted(map(repr, trie_plainly(rows))) and len(calls) == 2
