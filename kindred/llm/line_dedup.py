r"""Line dedup by content-defined chunks of lines, in DataFrame code only.

A text is split at ``\n``.  A rolling polynomial over the last ``WINDOW`` line hashes puts a
boundary after a line when its value falls in one of ``DIVISOR`` classes, so an inserted line
moves boundaries only nearby.  Chunks of two or more lines with words are grouped over all
documents by hash and bytes; each that occurs more than once stays where it comes first
(smallest doc_id, then place) and goes everywhere else.

Bytes decide: groups are made by (hash, chunk text) with partial aggregation, so a chunk that
a third of all documents share sends one row per task.  Decisions travel by hash alone; where
two different texts share a hash, they carry the text and the last step compares it.

``line_dedup`` does this and equals its SQL twin; runs of equal lines that the boundaries cut into
pieces of one line stay in it.  ``without_repeated_lines``, the stage of the pipeline, removes the
same chunks and then what of a repeated run lies beyond them: beside the chunks it takes every window
of two neighbouring lines with words (and what lies between them), and every line of over
``PASSAGE_WORDS`` words, and removes the lines of each that stands earlier too.  So each repeated run
goes from edge to edge, and every line that goes still stands where it came first.  Windows are
grouped and compared as chunks are.

Defined cases: a NULL text stays NULL and has no lines; an empty one has one empty line;
chunks of one line, and of lines without words, never go (of the windows: lone lines of few
words; lines without words go where they stand inside a window or a repeated chunk); rows of equal doc_id count as one
place, so repeated rows keep the same lines; a NULL doc_id comes last; an empty table gives
an empty result; other columns are kept, one named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.expressions import WORD, carry, let, words_of
from kindred.session import cut_lineage

#: Lines whose hashes decide on a boundary, the factor of the polynomial, and one boundary in so many lines.
WINDOW = 2
FACTOR = 1099
DIVISOR = 3
#: A line of more words than this is a window of its own.
PASSAGE_WORDS = 50
RESULTS = ["n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines"]
LAST = (1 << 63) - 1


def _at(array: Column, i: Column) -> Column:
    return F.element_at(array, i.cast("int"))


def chunk_hash(text: Column) -> Column:
    return F.xxhash64(text)


def chunk_ends(lines: Column) -> Column:
    """Last lines (from 1) of the chunks of ``lines``."""

    def rolled(h: Column, i: Column) -> Column:
        terms = [F.when(i > k, F.get(h, i - 1 - k) * FACTOR**k).otherwise(F.lit(0)) for k in range(WINDOW)]
        return sum(terms[1:], terms[0])

    def ends(h: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.size(h)), lambda i: (i == F.size(h)) | (F.floor(rolled(h, i) / 4096) % DIVISOR == 0)
        )

    return let(F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")), ends)


def _chunk_start(e: Column, i: Column) -> Column:
    return F.when(i == 0, 1).otherwise(F.get(e, i - 1) + 1)


def line_chunks(text: Column) -> Column:
    """Chunks of a text in order: first line (from 1), number of lines, lines with words, bytes."""

    def cut(lines: Column) -> Column:
        def spans(e: Column) -> Column:
            def chunk(end: Column, i: Column) -> Column:
                part = lambda: F.slice(lines, _chunk_start(e, i), end - _chunk_start(e, i) + 1)
                return let(
                    part(),
                    lambda p: F.struct(
                        i.alias("ordinal"),
                        F.size(p).alias("n"),
                        (F.size(F.filter(p, lambda x: x.rlike(WORD))) > 1).alias("multi"),
                        F.array_join(p, "\n").alias("text"),
                    ),
                )

            return F.transform(e, chunk)

        return let(chunk_ends(lines), spans)

    return let(F.split(F.coalesce(text, F.lit("")), "\n"), cut)


def line_pieces(text: Column) -> Column:
    """Chunks of two or more lines with words, then windows: the pairs and the long lines; first and last line (from 1), bytes."""

    def cut(lines: Column) -> Column:
        span = lambda a, b: F.struct(a.alias("first"), b.alias("last"))
        # of so many words only if of twice as many characters: spares most lines the split
        long = lambda x: (F.length(x) > 2 * PASSAGE_WORDS) & (F.size(words_of(x)) > PASSAGE_WORDS)

        def chunks(worded: Column) -> Column:
            multi = lambda s: F.size(F.filter(worded, lambda i: (i >= s["first"]) & (i <= s["last"]))) > 1
            return F.filter(let(chunk_ends(lines), lambda e: F.transform(e, lambda end, i: span(_chunk_start(e, i), end))), multi)

        def spans(worded: Column) -> Column:
            following = F.slice(worded, 2, F.greatest(F.size(worded) - 1, F.lit(0)))
            alone = F.filter(worded, lambda i: long(_at(lines, i)))
            pairs = F.transform(following, lambda b, k: span(F.get(worded, k), b))
            return F.array_distinct(F.concat(chunks(worded), pairs, F.transform(alone, lambda i: span(i, i))))

        def piece(s: Column, i: Column) -> Column:
            return F.struct(
                i.alias("ordinal"),
                s["first"].alias("first"),
                s["last"].alias("last"),
                F.lit(True).alias("multi"),
                F.array_join(F.slice(lines, s["first"], s["last"] - s["first"] + 1), "\n").alias("text"),
            )

        worded = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: _at(lines, i).rlike(WORD))
        return F.transform(let(worded, spans), piece)

    return let(F.split(F.coalesce(text, F.lit("")), "\n"), cut)


def _decisions(keyed: DataFrame) -> DataFrame:
    """Per document key the repeated chunks it holds: hash, place, first holder, text to compare."""
    multi = lambda *more: (
        keyed.select("_id", "_t", F.explode_outer("_chunks").alias("c"))
        .where("c.multi")
        .select(*more, chunk_hash(F.col("c.text")).alias("h"))
    )
    groups = multi("_id", F.col("c.text").alias("bytes")).groupBy("h", "bytes").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
    hashes = groups.groupBy("h").agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("n"), F.min("first").alias("first"))
    # written, so that the texts are shuffled once; a few columns of numbers for each repeated hash
    repeated = cut_lineage(hashes.where("n > 1"))
    held = repeated.where("variants = 1").select("h", "first", F.lit(None).cast("string").alias("bytes"))
    collided = repeated.where("variants > 1").select("h")
    if not collided.isEmpty():
        held = held.unionByName(groups.where("n > 1").join(collided, "h").select("h", "first", "bytes"))
    found = multi("_id", "_t", F.col("c.ordinal").alias("ordinal")).join(held, "h")
    # a set: rows of one id and text bring the same decisions
    return found.groupBy("_id", "_t").agg(F.collect_set(F.struct("h", "bytes", "ordinal", "first")).alias("_found"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """Documents with the chunks that come earlier elsewhere taken out of ``text``.

    Adds ``n_lines``, ``n_chunks``, ``n_removed_chunks`` and ``n_removed_lines``.
    """
    return carry(docs, ["doc_id", "text"], RESULTS, _deduplicated)


def _found(docs: DataFrame, pieces: Callable[[Column], Column]) -> DataFrame:
    """Documents with their keys and the repeated pieces that each holds."""
    keys = {"_id": F.coalesce("doc_id", F.lit(LAST)), "_t": F.xxhash64("text")}
    rows = docs.withColumns(keys)
    decisions = _decisions(rows.select("_id", "_t", pieces(F.col("text")).alias("_chunks")))
    return rows.join(decisions, ["_id", "_t"], "left")


def _gone(chunks: Column) -> Column:
    """Places of the chunks to remove."""
    real = F.filter(
        F.coalesce("_found", F.array()), lambda d: d["bytes"].isNull() | (d["bytes"] == F.get(chunks, d["ordinal"])["text"])
    )

    def later(s: Column) -> Column:
        known = lambda d, i: (i > 0) & (F.get(s, i - 1)["h"] == d["h"]) & F.get(s, i - 1)["bytes"].eqNullSafe(d["bytes"])
        return F.transform(F.filter(s, lambda d, i: (d["first"] != F.col("_id")) | known(d, i)), lambda d: d["ordinal"])

    return let(F.array_distinct(F.sort_array(real)), later)


def _deduplicated(docs: DataFrame) -> DataFrame:
    rows = _found(docs, line_chunks)

    def settled(chunks: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(chunks) - 1)

        def result(kept: Column) -> Column:
            lines = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, c: x + c["n"])
            stay = F.transform(kept, lambda i: F.get(chunks, i))
            return let(
                stay,
                lambda s: F.struct(
                    F.array_join(F.transform(s, lambda c: c["text"]), "\n").alias("text"),
                    lines(chunks).alias("n_lines"),
                    F.size(chunks).cast("long").alias("n_chunks"),
                    (F.size(chunks) - F.size(s)).cast("long").alias("n_removed_chunks"),
                    (lines(chunks) - lines(s)).alias("n_removed_lines"),
                ),
            )

        return let(F.array_except(places, _gone(chunks)), result)

    rows = rows.withColumn("_r", let(line_chunks(F.col("text")), settled))
    null = F.col("text").isNull()
    results = {c: F.when(null, F.lit(0).cast("long")).otherwise(F.col(f"_r.{c}")) for c in RESULTS}
    return rows.withColumns({"text": F.when(~null, F.col("_r.text")), **results})


def _without_pieces(docs: DataFrame) -> DataFrame:
    """Documents without the lines of repeated chunks and windows, and ``n_removed_lines``."""
    rows = _found(docs, line_pieces)

    def gone(pieces: Column) -> Column:
        lines_of = lambda p: F.sequence(p["first"], p["last"])
        return F.flatten(F.transform(_gone(pieces), lambda i: lines_of(F.get(pieces, i))))

    def settled(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(1), F.size(lines)), let(line_pieces(F.col("text")), gone))
        return let(
            kept,
            lambda k: F.struct(
                F.array_join(F.transform(k, lambda i: _at(lines, i)), "\n").alias("text"),
                (F.size(lines) - F.size(k)).cast("long").alias("n"),
            ),
        )

    some = F.col("_found").isNotNull() & F.col("text").isNotNull()
    rows = rows.withColumn("_r", F.when(some, let(F.split("text", "\n"), settled)))
    return rows.withColumns({"text": F.when(some, F.col("_r.text")).otherwise(F.col("text")), "n_removed_lines": F.when(some, F.col("_r.n")).otherwise(0)})


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents without the lines of repeated chunks and windows, with their own columns; those left without a word go.

    ``n_chars``, where present, is the new length.  A document that had no word before stays.
    """

    def body(rows: DataFrame) -> DataFrame:
        rows = _without_pieces(rows).where(F.coalesce(F.col("text").rlike(WORD), F.lit(True)) | (F.col("n_removed_lines") == 0))
        if "n_chars" not in rows.columns:
            return rows
        length = F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))
        return rows.withColumn("n_chars", length.cast(rows.schema["n_chars"].dataType))

    return carry(docs, ["doc_id", "text", "n_chars"], [], body)
