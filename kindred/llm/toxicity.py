"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters look at a text's words: lists of hostile words by theme, terms (words and beginnings of
words) that the labelled rows single out, dealt into several lists, and patterns of writing.
How often every pattern of votes occurs is counted over **all** documents; there are at most
``3 * 2 ** VOTERS`` patterns, whatever the corpus.  From these counts EM fits a latent class
model: the given label is one more voter that may err or abstain, every voter has its own
rates in both classes, and voters that still agree once the class is known (correlated ones)
are modelled jointly, as a block with a full table.  A row's posterior under this model is the
target of a logistic regression on hashed terms and votes, which scores every whole text.

Labels come only from rows with ``crc32(doc_id) mod 5 <> 0``, and of those the ``TRAIN_ROWS`` with
smallest hash: that bounds the lists and the classifier.  The score uses nothing but the text.

Defined cases: a NULL or empty text has no word, so its score is the one of no evidence; words
of any length and texts of any length are read whole; a doc_id with several labels or with
several texts trains with each pair of them; NULL doc_ids and NULL labels train nothing, and a
NULL doc_id is not held out; equal rows are scored alike; without any label of both kinds the
fixed lists decide; an empty table gives an empty result; other columns are kept, one named
like a result column is replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.expressions import carry, only
from kindred.session import cut_lineage, task_count

#: Most labelled rows that train, terms in mined lists, hashed weights, words a worker remembers.
TRAIN_ROWS, MINED_TERMS, WEIGHTS, CACHE_WORDS = 20_000, 2_000, 1 << 18, 400_000
#: A term is mined if it stands in toxic rows more often than chance: by likelihood ratio, and by its share against that of all.
MINED_G2, MINED_LIFT = 18.0, 4.0
FOLDS = 5
WORDS = re.compile(r"[^\W\d_]+").findall
STEMS = (4, 5, 6, 7)

# Hostile words by theme, in four languages; none is harmless in another of them (as "die" is).
THEMES = {
    "insults": "idiot idiots moron morons stupid dumb fool loser losers clown imbecile idiota imbécil estúpido tonto payaso crétin "
    "débile abruti clowne dummkopf trottel depp blödmann",
    "contempt": "worthless pathetic disgusting trash scum garbage filth vermin despicable basura asqueroso patético escoria ordure "
    "pathétique dégoûtant abschaum widerlich erbärmlich müll dreck",
    "threats": "kill murder strangle matar golpear tuer crever frapper töten prügeln umbringen",
    "profanity": "damn crap bastard bitch shit fuck arse mierda puta cabrón merde putain connard salope scheiße arschloch hure",
}
MINED_LISTS = 4
PATTERNS = 6
VOTERS = len(THEMES) + MINED_LISTS + PATTERNS
CAPITALS, SHOUT = re.compile("[A-Z]{4}").search, re.compile(r"\b[A-Z]{4,}\b").search
#: Agreement given the class (as a correlation) from which two voters are modelled together, and voters of one block.
CORRELATED, BLOCK = 0.15, 6
#: How far a given label is trusted at least, in either class.
LABEL_TRUST = 0.8
EPOCHS, STEP, SHRINK = 12, 0.3, 1e-5
RESULTS = ["held_out", "score", "predicted"]


def crc(term: str) -> int:
    return zlib.crc32(term.encode())


def terms_of(word: str) -> list[str]:
    """A word and its marked beginnings."""
    return [word, *[word[:n] + "-" for n in STEMS if len(word) > n]]


class Reader:
    """What a text says: its distinct words, and a bit per theme, mined list and pattern."""

    def __init__(self, mined: list[str]):
        self.lists = [set(words.split()) for words in THEMES.values()] + [set() for _ in range(MINED_LISTS)]
        for term in mined:  # stems apart from words, each dealt by hash
            self.lists[len(THEMES) + 2 * term.endswith("-") + crc(term) % 2].add(term)
        self.every = set().union(*self.lists)
        self.seen, self.hostile = set(), {}

    def _look(self, words: set[str]) -> None:
        """Remember which of new words are in a list, and in which."""
        if len(self.seen) + len(words) > CACHE_WORDS:
            self.seen, self.hostile = set(), {}
        self.seen |= words
        for w in words:
            hits = self.every.intersection(terms_of(w))
            if hits:
                self.hostile[w] = sum(1 << j for j, names in enumerate(self.lists) if not names.isdisjoint(hits))

    def __call__(self, text: str) -> tuple[set[str], int]:
        words = WORDS(text.lower())
        distinct = set(words)
        self._look(distinct - self.seen)
        found, at = self.hostile.keys() & distinct, len(self.lists)
        bits = ("!!" in text or CAPITALS(text) is not None and SHOUT(text) is not None) << at + 5
        if found:
            said = sum(w in found for w in words)
            for w in found:
                bits |= self.hostile[w]
            bits |= (said > 1) << at | (len(found) > 1) << at + 1 | (len(found) > 3) << at + 2
            bits |= (said * 200 > len(words)) << at + 3 | (said * 100 > len(words)) << at + 4
        return distinct, bits


class LabelModel:
    """Latent class model of vote patterns; ``counts`` maps (bits, label or -1) to documents."""

    def __init__(self, counts: dict[tuple[int, int], int], rounds: int = 60):
        self.keys = sorted(counts)
        self.n = np.array([counts[k] for k in self.keys], float)
        self.votes = np.array([[bits >> j & 1 for j in range(VOTERS)] for bits, _ in self.keys], np.int64).reshape(-1, VOTERS)
        self.label = np.array([label for _, label in self.keys])
        theme = self.votes[:, : len(THEMES) + MINED_LISTS].any(axis=1)
        post = np.where(self.label < 0, np.where(theme, 0.7, 0.05), np.where(self.label == 1, 0.9, 0.05))
        self.blocks = [[j] for j in range(VOTERS)]
        for at in range(rounds):
            if at in (5, 15):
                self.blocks = self._correlated(post)
            self._fit(post)
            post = self._posterior()
        self.post = dict(zip(self.keys, post.tolist()))

    def _weights(self, post: np.ndarray) -> list[np.ndarray]:
        return [self.n * (1 - post), self.n * post]

    def correlations(self, post: np.ndarray) -> np.ndarray:
        """Voters' correlation within the classes, averaged by class size."""
        total = np.zeros((VOTERS, VOTERS))
        for w in self._weights(post):
            size = w.sum()
            if size < 5:
                continue
            mean = w @ self.votes / size
            cov = (self.votes * w[:, None]).T @ self.votes / size - np.outer(mean, mean)
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-4))
            total += size / self.n.sum() * cov / np.outer(spread, spread)
        return total

    def _correlated(self, post: np.ndarray) -> list[list[int]]:
        """Blocks of voters, strongest correlations first, none larger than ``BLOCK``."""
        strength = np.abs(self.correlations(post))
        of = {j: [j] for j in range(VOTERS)}
        pairs = sorted(((strength[i, j], i, j) for i in range(VOTERS) for j in range(i)), reverse=True)
        for s, i, j in pairs:
            if s >= CORRELATED and of[i] is not of[j] and len(of[i]) + len(of[j]) <= BLOCK:
                of[i].extend(of[j])
                for x in of[j]:
                    of[x] = of[i]
        return [list(x) for x in {id(b): sorted(b) for b in of.values()}.values()]

    def _fit(self, post: np.ndarray) -> None:
        weights = self._weights(post)
        self.prior = np.array([w.sum() + 1 for w in weights])
        self.prior /= self.prior.sum()
        self.tables, self.label_rate = [], []
        for w in weights:
            tables = []
            for block in self.blocks:
                code = self.votes[:, block] @ (1 << np.arange(len(block)))
                # a block's table leans on its voters' own rates, so unseen patterns keep their meaning
                rates = (w @ self.votes[:, block] + 0.5) / (w.sum() + 1)
                every = (np.arange(1 << len(block))[:, None] >> np.arange(len(block))) & 1
                prior = np.prod(np.where(every, rates, 1 - rates), axis=1)
                tables.append((np.bincount(code, weights=w, minlength=1 << len(block)) + 2 * prior) / (w.sum() + 2))
            self.tables.append(tables)
            known = w * (self.label >= 0)
            self.label_rate.append((known @ (self.label == 1) + 0.5) / (known.sum() + 1))
        # the classes stay the ones that labels mean
        self.label_rate = [min(self.label_rate[0], 1 - LABEL_TRUST), max(self.label_rate[1], LABEL_TRUST)]

    def _posterior(self) -> np.ndarray:
        logs = []
        for c in (0, 1):
            score = np.full(len(self.keys), math.log(self.prior[c]))
            for block, table in zip(self.blocks, self.tables[c]):
                score += np.log(table[self.votes[:, block] @ (1 << np.arange(len(block)))])
            rate = self.label_rate[c]
            score += np.select([self.label == 1, self.label == 0], [math.log(rate), math.log(1 - rate)], 0.0)
            logs.append(score)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def term_places(words: set[str]) -> np.ndarray:
    """Hashed terms of distinct words; terms that words share repeat."""
    return np.array([crc(t) & (WEIGHTS - 1) for w in words for t in terms_of(w)], np.int32)


def features(places: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's weights and their values: hashed terms, votes, a constant."""
    hashed, times = np.unique(places, return_counts=True)
    dense = [*[WEIGHTS + j for j in range(VOTERS) if bits >> j & 1], WEIGHTS + VOTERS]
    return np.r_[hashed, dense].astype(np.int64), np.r_[times / math.sqrt(max(len(places), 1)), np.ones(len(dense))]


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Logistic regression on soft labels by adaptive steps, in the order given."""
    w, seen = np.zeros(WEIGHTS + VOTERS + 1), np.full(WEIGHTS + VOTERS + 1, 1e-2)
    for _ in range(EPOCHS):
        for places, values, target in rows:
            step = (_sigmoid(w[places] @ values) - target) * values + SHRINK * w[places]
            seen[places] += step * step
            w[places] -= STEP * step / np.sqrt(seen[places])
    return w


def fixed_rows(read: Reader) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """A word of each theme as a hostile row, and as many rows that say nothing: what decides without labels."""
    words = [w for theme in THEMES.values() for w in theme.split()]
    said = [(*features(np.sort(term_places({w})), read(w)[1]), 0.9) for w in words]
    return said + [(*features(term_places(set()), 0), 0.03)] * len(words)


class Scorer:
    """Scores texts with fitted weights; a word's share of the sum is remembered."""

    def __init__(self, mined: list[str], weights: np.ndarray):
        self.read, self.weights = Reader(mined), weights.tolist()
        self.share, self.count = {}, {}  # of each word: its weights' sum, its terms
        self.dense = weights[WEIGHTS:].tolist()

    def __call__(self, text: str) -> float:
        words, bits = self.read(text)
        new = words.difference(self.share)
        if len(self.share) + len(new) > CACHE_WORDS:
            self.share, self.count, new = {}, {}, words
        for w in new:
            terms = terms_of(w)
            self.share[w] = math.fsum([self.weights[crc(t) & (WEIGHTS - 1)] for t in terms])
            self.count[w] = len(terms)
        total, n = math.fsum(map(self.share.__getitem__, words)), sum(map(self.count.__getitem__, words))
        return _sigmoid(total / math.sqrt(max(n, 1)) + sum(x for j, x in enumerate(self.dense[:-1]) if bits >> j & 1) + self.dense[-1])


# -- on Spark --------------------------------------------------------------------------------


def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``(h, text, toxic)``, written: distinct labelled texts that may train, at most ``rows``, those of smallest hash."""
    known = only(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(_fold(F.col("doc_id")) != 0)
    ids = known.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    found = docs.join(F.broadcast(ids), "doc_id").select(F.xxhash64("doc_id").alias("h"), F.coalesce("text", F.lit("")).alias("text"), "toxic").distinct()
    order = ["h", F.xxhash64("text"), "text", "toxic"]
    return cut_lineage(found.orderBy(*order).limit(rows).repartition(task_count(docs.sparkSession)))


def mined_terms(sample: DataFrame) -> list[str]:
    """At most ``MINED_TERMS`` terms that stand in toxic rows more often than chance, strongest first."""
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = size.get(0, 0), size.get(1, 0)
    if not clean or not toxic:
        return []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally = (Counter(), Counter())
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                tally[label].update({t for w in set(WORDS(text.as_py().lower())) for t in terms_of(w)})
            terms = list(tally[0].keys() | tally[1].keys())
            columns = [pa.array(terms, pa.string()), *[pa.array([t[x] for x in terms], pa.int64()) for t in tally]]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "a", "b"])

    share = toxic / (clean + toxic)
    counts = sample.select("text", "toxic").mapInArrow(count, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    log = lambda n, p: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / ((F.col("a") + F.col("b")) * F.lit(p)))).otherwise(0.0)
    g2 = 2 * (log("a", 1 - share) + log("b", share))
    strong = counts.where(F.col("b") * (clean + 1) > MINED_LIFT * (F.col("a") + 1) * (toxic + 1)).withColumn("g2", F.round(g2, 6))
    return [r["term"] for r in strong.where(F.col("g2") > MINED_G2).orderBy(F.desc("g2"), "term").limit(MINED_TERMS).collect()]


def vote_counts(docs: DataFrame, mined: list[str]) -> dict[int, int]:
    """Documents of the whole corpus per pattern of votes, at most ``2 ** VOTERS``."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, counts = Reader(mined), Counter()
        for batch in batches:
            counts.update(read(text.as_py() or "")[1] for text in batch.column(0))
        yield pa.RecordBatch.from_pydict({"bits": pa.array(list(counts), pa.int64()), "n": pa.array(list(counts.values()), pa.int64())})

    return {r["bits"]: r["n"] for r in docs.select("text").mapInArrow(vote, "bits long, n long").groupBy("bits").agg(F.sum("n").alias("n")).collect()}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[list[str], LabelModel, np.ndarray]:
    """Mined terms, label model and weights."""
    docs = only(docs, "doc_id", "text")
    sample = labelled_sample(docs, labels)
    mined = mined_terms(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(mined)
        for batch in batches:
            rows = [read(text.as_py()) for text in batch.column(1)]
            places = [np.sort(term_places(words)).tobytes() for words, _ in rows]
            columns = [batch.column(0), batch.column(2), pa.array([bits for _, bits in rows], pa.int64()), pa.array(places, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "toxic", "bits", "places"])

    rows = cut_lineage(sample.mapInArrow(measure, "h long, toxic int, bits long, places binary"))
    counts = Counter({(bits, -1): n for bits, n in vote_counts(docs, mined).items()})
    for r in rows.groupBy("bits", "toxic").count().collect():
        counts[r["bits"], r["toxic"]] += r["count"]
        counts[r["bits"], -1] = max(counts[r["bits"], -1] - r["count"], 0)
    model = LabelModel(counts)
    posterior = model.post

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(x for batch in batches for x in zip(*[batch.column(c).to_pylist() for c in ("h", "toxic", "bits", "places")]))
        targets = fixed_rows(Reader(mined))
        targets += [(*features(np.frombuffer(places, np.int32), bits), posterior[bits, toxic]) for _, toxic, bits, places in held]
        yield pa.RecordBatch.from_pydict({"weights": [fit_linear(targets).astype(np.float32).tobytes()]})

    weights = rows.coalesce(1).mapInArrow(learn, "weights binary").first()
    return mined, model, np.frombuffer(bytes(weights["weights"]), np.float32).astype(float) if weights else fit_linear(fixed_rows(Reader(mined)))


def score(docs: DataFrame, mined: list[str], weights: np.ndarray) -> DataFrame:
    """Documents with ``held_out``, ``score`` and ``predicted``."""
    shipped = docs.sparkSession.sparkContext.broadcast((mined, weights.astype(np.float32)))  # of fixed size

    def scored(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c != "text"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(shipped.value[0], shipped.value[1].astype(float))
            for batch in batches:
                scores = [scorer(text.as_py() or "") for text in batch.column(0)]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], names=[*kept, "score"])

        fields = rows.select(*kept).schema.add("score", "double")
        out = rows.select("text", *kept).mapInArrow(run, fields).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        return out.withColumn("held_out", F.coalesce(_fold(F.col("doc_id")) == 0, F.lit(False))).withColumn("text", F.lit(None).cast("string"))

    return carry(docs, ["doc_id", "text"], [*RESULTS, "text"], scored).drop("text")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, less their texts, with ``held_out``, ``score`` and ``predicted``, by a model fitted on them."""
    mined, _, weights = fit(docs, labels)
    return score(docs, mined, weights)
