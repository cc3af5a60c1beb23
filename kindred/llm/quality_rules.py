"""Quality rules: base counts and a hashed n-gram likelihood ratio, in DataFrame code only.

A document's score is the mean over its tokens' unigrams and bigrams of
``ln(p_target / p_raw)``: both are multinomials over ``BUCKETS`` hash buckets with add-one
smoothing, ``raw`` counted over all documents and ``target`` over the trusted ones.  With a
``prior`` the weight is ``ln((t + prior) / (e + prior))`` instead: a bucket's target count
against the one expected from its share of ``raw``, so that a bucket of few expected n-grams
weighs about 0 whatever the sizes of table and target; the query and the pipeline use that.  A
document passes when its score reaches ``THRESHOLD``; nothing is drawn at random.

Trusted documents are those labelled quality 1 and not toxic.  At most ``TARGET_ROWS`` of
them are used, those with the smallest hash of their id, so that their ids may be broadcast
(160 kB).  The weights are one array of ``BUCKETS`` doubles (512 kB), read as a scalar.
No document is shuffled: counting sends one row per bucket and task, scoring is a map.

Defined cases: a text that is NULL, empty or blank has no words, fails the base rules and has
score 0; without trusted documents every score is 0 and the base rules decide alone; a NULL id
is never trusted; repeated rows are counted and judged one by one; an empty table gives an
empty result; other columns are kept, one named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.expressions import WORD, carry, let, only, words_of

BUCKETS = 1 << 16
TARGET_ROWS = 20_000
#: Nats per n-gram.  Ordinary documents lie above -0.1, such with a third of junk tokens below -0.4.
THRESHOLD = -0.25
#: n-grams added to a bucket's target count and to the expected one.
PRIOR = 4.0
MIN_WORDS = 50
#: Highest share of repeated words, in percent.
MAX_REPEAT = 50
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
SYMBOLS = "#*$%&|<>"
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that stand twice or more in ``words``.

    Windows are compared by 64-bit hash within one document; equal ones stand side by side
    after a sort by (hash, place), so the work is n log n however often one window repeats.
    """
    at = lambda a, i: F.element_at(a, i.cast("int"))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            last = F.size(s)
            same = lambda j, k: at(s, j)["h"] == at(s, k)["h"]
            flagged = F.filter(
                F.sequence(F.lit(1), last), lambda j: F.when(j > 1, same(j, j - 1)).otherwise(False) | F.when(j < last, same(j, j + 1)).otherwise(False)
            )
            places = F.transform(flagged, lambda j: at(s, j)["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, repeated))

    windows = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(at(w, i), at(w, i + 1), at(w, i + 2))
    )
    return F.when(F.size(words) < 3, 0).otherwise(let(windows(words), covered)).cast("long")


def base_rules(docs: DataFrame) -> DataFrame:
    """Documents with the base counts and ``base_failed``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    measured = let(
        words_of(F.col("text")),
        lambda w: let(
            repeat_words(w),
            lambda repeated: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated.alias("n_repeat_words"),
                # in the struct, so that a filter on the verdict measures a text once
                ((F.size(w) < MIN_WORDS) | (100 * repeated > MAX_REPEAT * F.size(w))).alias("base_failed"),
            ),
        ),
    )
    rows = docs.withColumns(
        {
            "_m": measured,
            "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    )
    return rows.select("*", "_m.*").drop("_m")


def gram_buckets(text: Column) -> Column:
    """Buckets of the unigrams and bigrams of a text's lower-cased words and sign runs."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    bucket = lambda *x: F.pmod(F.xxhash64(*x), F.lit(BUCKETS)).cast("int")
    pairs = lambda t: F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda x, i: bucket(F.element_at(t, i + 1), x))
    return let(tokens, lambda t: F.concat(F.transform(t, lambda x: bucket(x)), pairs(t)))


def trusted_ids(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """At most ``rows`` ids labelled quality 1 and not toxic, those of smallest hash."""
    good = only(labels, "doc_id", "quality", "toxic").where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def gram_weights(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """One row: the array ``weights`` of ``ln(p_target / p_raw)`` by bucket, add-one or with a ``prior``."""
    trusted = F.broadcast(trusted_ids(labels).withColumn("_trusted", F.lit(1)))
    grams = docs.select("doc_id", gram_buckets(F.col("text")).alias("grams")).join(trusted, "doc_id", "left")
    counts = (
        grams.select(F.explode_outer("grams").alias("id"), F.coalesce("_trusted", F.lit(0)).alias("t"))  # outer: no filter that counts the grams again
        .where("id IS NOT NULL")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    )
    every = docs.sparkSession.range(BUCKETS).join(counts.withColumn("id", F.col("id").cast("long")), "id", "left").na.fill(0, ["raw", "target"])
    sums = every.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"), F.sort_array(F.collect_list(F.struct("id", "raw", "target"))).alias("by"))
    shrunk = lambda x: F.log((x["target"] + F.lit(prior)) / (F.col("target") * (x["raw"] / F.col("raw")) + F.lit(prior)))
    plain = lambda x: F.log((x["target"] + 1.0) / (F.col("target") + BUCKETS)) - F.log((x["raw"] + 1.0) / (F.col("raw") + BUCKETS))
    ratio = plain if prior is None else shrunk
    return sums.select(F.when(F.col("target") > 0, F.transform("by", ratio)).otherwise(F.transform("by", lambda x: F.lit(0.0))).alias("weights"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, prior: float | None = None) -> DataFrame:
    """Documents with the base counts, ``base_failed``, ``score`` and ``kept``."""
    return carry(docs, ["doc_id", "text"], RESULTS, lambda rows: _judged(rows, labels, threshold, prior))


def _judged(docs: DataFrame, labels: DataFrame, threshold: float, prior: float | None) -> DataFrame:
    weights = gram_weights(docs.select("doc_id", "text"), labels, prior).scalar()  # named first: a subquery may not stand in a lambda
    total = lambda grams, w: F.aggregate(grams, F.lit(0.0), lambda x, g: x + F.element_at(w, g + 1))
    mean = lambda grams: F.when(F.size(grams) == 0, 0.0).otherwise(
        let(F.col("_weights"), lambda w: total(grams, w)) / F.size(grams)
    )
    rows = base_rules(docs).withColumn("_weights", weights).withColumn("score", let(gram_buckets(F.col("text")), mean))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, prior: float | None = None) -> DataFrame:
    """The documents that the rules keep, with all their own columns."""
    return carry(docs, ["doc_id", "text"], [], lambda rows: _judged(rows, labels, threshold, prior).where("kept"))
