"""License scans by a positional index of rare licence words.

A template is a notice with mandatory key phrases.  Document frequencies of the templates'
words, counted over all documents, give their IDF; the index holds each template's
``RARE`` words of highest IDF with their places.  A file's occurrences of indexed words are
looked up, and postings of one template that agree on the relative position (file place less
template place) form an alignment.  An alignment of ``AGREE`` rare words (all of them where a
template has fewer) is verified: every key phrase must stand within ``SLACK`` words of its
place.  The score is the IDF share of template words that stand at their exact place.

The base phrases are three more entries: every place of a phrase holds its rarest word, so
looking up that word and comparing the rest finds them all.

The scan is a map over documents; nothing is shuffled but document frequencies, one row per
template word (about a hundred) and task.

Defined cases: a NULL text counts as empty; a text without words has no places, no labels
(empty strings), NULL first and last word and score 0; texts are read whole; repeated rows
are scanned one by one; an empty table gives an empty result; other columns are kept, one
named like a result column is replaced.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.expressions import carry, only

# fixed values: base phrases and their labels
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# fixed values: label, notice, key phrases of which each must stand near its place
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license see the license file for details", ["mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
        ["in compliance with the license", "apache org licenses"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ["source and binary forms", "following conditions are met"],
    ),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation",
        ["gnu general public license"],
    ),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation",
        ["gnu lesser general public license"],
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ["for any purpose with or without fee"],
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("proprietary", "all rights reserved no part of this document may be reproduced", ["all rights reserved", "may be reproduced"]),
]
#: Rare words kept per template, how many must agree on a relative position, words a key phrase may be off its place.
RARE, AGREE, SLACK = 4, 2, 3
#: Bytes to word bytes (lower case) or a blank.
TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
VOCABULARY = frozenset(w.encode() for _, text, _ in TEMPLATES for w in text.split()) | frozenset(
    w.encode() for phrase, _ in BASE for w in phrase.split()
)
FIELDS = [
    ("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"),
    ("base_labels", "string"), ("labels", "string"), ("score", "double"),
]
RESULTS = [name for name, _ in FIELDS]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


class Index:
    """Postings of the templates' rare words, for one table of inverse document frequencies."""

    def __init__(self, idf: dict[bytes, float]):
        self.idf = idf
        self.templates = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (label, text, keys) in enumerate(TEMPLATES):
            words = [w.encode() for w in text.split()]
            rare = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE]
            for place, w in enumerate(words):
                if w in rare:
                    self.postings[w].append((t, place))
            phrases = [(p, x) for k in keys for x in [[w.encode() for w in k.split()]] for p in _places(words, x)]
            self.templates.append((label, words, min(AGREE, len(rare)), phrases, sum(idf[w] for w in words)))
        self.base: dict[bytes, list[tuple[list[bytes], int, str]]] = defaultdict(list)
        for phrase, label in BASE:
            words = [w.encode() for w in phrase.split()]
            anchor = max(range(len(words)), key=lambda i: idf[words[i]])
            self.base[words[anchor]].append((words, anchor, label))
        self.looked_up = frozenset(self.postings) | frozenset(self.base)

    def verified(self, words: list[bytes], t: int, offset: int) -> float:
        """Score of template ``t`` laid at ``offset``, or 0 where a key phrase is missing."""
        _, template, _, phrases, total = self.templates[t]
        for place, phrase in phrases:
            at = offset + place
            if not any(words[i : i + len(phrase)] == phrase for i in range(max(0, at - SLACK), at + SLACK + 1)):
                return 0.0
        held = sum(self.idf[w] for i, w in enumerate(template) if 0 <= offset + i < len(words) and words[offset + i] == w)
        return held / total

    def scan(self, words: list[bytes]) -> tuple:
        found = self.looked_up.intersection(words)
        starts, base, labels, score = [], set(), set(), 0.0
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for i, w in enumerate(words) if found else ():
            if w not in found:
                continue
            for phrase, anchor, label in self.base.get(w, ()):
                s = i - anchor
                if s >= 0 and words[s : s + len(phrase)] == phrase:
                    starts.append(s)
                    base.add(label)
                    score = 1.0
            for t, place in self.postings.get(w, ()):
                votes[t, i - place].add(w)
        for (t, offset), agreed in votes.items():
            if len(agreed) >= self.templates[t][2] and (value := self.verified(words, t, offset)):
                labels.add(self.templates[t][0])
                score = max(score, value)
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), min(1.0, score),
        )


def _texts(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[str | None]:
    for batch in batches:
        for value in batch.column(column):
            yield value.as_py()


def word_idf(docs: DataFrame) -> dict[bytes, float]:
    """IDF of every template word over all documents; brings one row per word to the driver."""

    def count(batches):
        seen: Counter[bytes] = Counter()
        n = 0
        for text in _texts(batches, 0):
            n += 1
            seen.update(VOCABULARY.intersection(words_of(text)))
        yield pa.RecordBatch.from_pydict({"word": [b"", *seen], "n": [n, *seen.values()]})

    rows = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {bytes(r["word"]): r["n"] for r in rows}
    n = df.get(b"", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in VOCABULARY}


def license_scan(docs: DataFrame) -> DataFrame:
    """Documents with word count, base places and labels, the method's labels and its score."""
    idf = word_idf(only(docs, "text"))
    return carry(docs, ["text"], RESULTS, lambda rows: _scanned(rows, idf))


def _scanned(docs: DataFrame, idf: dict[bytes, float]) -> DataFrame:
    kept = docs.columns
    schema = T.StructType([*docs.select(*kept).schema.fields, *[T.StructField(n, T.LongType() if k == "long" else T.DoubleType() if k == "double" else T.StringType()) for n, k in FIELDS]])
    at = kept.index("text")
    kinds = [pa.int64() if k == "long" else pa.float64() if k == "double" else pa.string() for _, k in FIELDS]

    def scan(batches):
        index = Index(idf)
        for batch in batches:
            rows = [index.scan(words_of(x.as_py())) for x in batch.column(at)]
            columns = list(zip(*rows)) or [()] * len(FIELDS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=[*kept, *RESULTS]
            )

    return docs.select(*kept).mapInArrow(scan, schema)
