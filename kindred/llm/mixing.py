"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The words of a source form one stream (documents in seeded order) that is cut into
blocks of equal length.  The highest quotients ``target / (2 s - 1)`` give every source
its seats, then every output shard its integer quota, and a seeded permutation of a
source's blocks says which blocks fill them.  All of it is DataFrame code.

Defined cases: a text that is NULL, empty or blank has size 0 and is never taken; a NULL
source is a source of its own, last in order; equal ids and repeated rows each keep their
own row; an empty table gives an empty result; other columns are kept, except that one
named like a result column (``size``, ``source_size``, ``target``, ``taken``, ``draws``)
is replaced.  Sources are aggregated before they are ordered, so a hot source is never
gathered; the source table itself (one row per source) is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.expressions import WORD, carry

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Words per block: a source's taken words miss its target by about one block.
BLOCK_WORDS = 128
#: Blocks per output shard.
SHARD_BLOCKS = 8192
SEED = 20240601
#: A block count below 2^63 cannot be divisible by all of these primes.
PRIMES = (1000003, 1000033, 1000037, 1000039)
#: Bits of a document's seeded place that name its inner and outer bucket.
INNER, OUTER = 40, 50
RESULTS = ["size", "source_size", "target", "taken", "draws"]


def _everything(order=None):
    w = Window.partitionBy(F.lit(0))
    return w.orderBy(*order) if order else w


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    """Documents with their size, source key ``_src`` and seeded place ``_u`` of 60 bits."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 15), 16, 10).cast("long")
    return (
        docs.withColumns(
            {
                "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
                "_src": F.when(F.col("source").isNull(), "t").otherwise(F.concat(F.lit("s"), "source")),
                "_u": place,
            }
        )
        .withColumns({"_inner": F.shiftright("_u", INNER), "_outer": F.shiftright("_u", OUTER)})
    )


def source_targets(sources: DataFrame, share: float = SHARE, weights=WEIGHTS) -> DataFrame:
    """``(_src, source_size)`` with its ``target``: weight shares, stopped at twice the size.

    Sources are filled in order of cap per weight; the level at the first source that
    stays under its cap is what resharing by weight ends at.
    """
    ordinal = F.row_number().over(_everything(["_src"])) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (ordinal % len(weights) + 1).cast("int"))
    rows = sources.withColumns({"_w": weight, "_cap": F.col("source_size") * float(MOST)})
    before = _everything([F.col("_cap") / F.col("_w"), F.col("_src")]).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_level": (F.sum("source_size").over(_everything()) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            / (F.sum("_w").over(_everything()) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))),
            "_ord": F.row_number().over(_everything([F.col("_cap") / F.col("_w"), F.col("_src")])),
        }
    )
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_ord"))
    level = F.min_by("_level", free).over(_everything())
    return rows.withColumn("target", F.least(F.col("_cap"), level * F.col("_w"))).drop("_w", "_cap", "_level", "_ord")


def _highest_quotients(rows: DataFrame, house: list[str], seats: str, votes: str, low: F.Column, high: F.Column) -> DataFrame:
    """Seats ``_seats`` per ``house`` and source: ``seats`` of a house go to the highest quotients.

    Every source surely has ``low`` seats and never more than ``high``; only the seats in
    between are ranked.
    """
    rows = rows.withColumns({"_low": low.cast("long"), "_high": high.cast("long")})
    house_w = Window.partitionBy(*[F.col(h) for h in house]) if house else _everything()
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_low").over(house_w))
    quotient = F.col(votes) / (2 * F.col("_s") - 1)
    ranked = (
        rows.where(F.col("_high") > F.col("_low"))
        .withColumn("_s", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))))
        .withColumn("_rank", F.row_number().over(house_w.orderBy(quotient.desc(), "_src", "_s")))
        .where(F.col("_rank") <= F.col("_open"))
        .groupBy(*house, "_src")
        .agg(F.count(F.lit(1)).alias("_more"))
    )
    return rows.join(ranked, [*house, "_src"], "left").withColumn("_seats", F.col("_low") + F.coalesce("_more", F.lit(0))).drop(
        "_low", "_high", "_open", "_more"
    )


def source_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks ``n_blocks`` of every source and its seats ``quota`` in the whole mix."""
    n_sources, votes = F.count(F.lit(1)).over(_everything()), F.sum("target").over(_everything())
    rows = targets.withColumns(
        {
            "n_blocks": F.ceil(F.col("source_size") / block_words).cast("long"),
            "_house": F.floor(votes / block_words).cast("long"),
            "_n": n_sources,
            "_share": F.when(votes > 0, F.col("target") / votes).otherwise(0.0),
        }
    )
    fair = F.col("_share") * F.col("_house")
    low = F.greatest(F.lit(0), F.floor(fair - F.col("_share") * F.col("_n") / 2) - 2)
    high = F.least(F.col("n_blocks") * MOST, F.ceil(fair) + F.col("_n") + 2)
    seated = _highest_quotients(rows, [], "_house", "target", F.least(low, high), high)
    return seated.withColumnRenamed("_seats", "quota").drop("_house", "_n", "_share")


def shard_quotas(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """Integer quotas ``(shard, source, first_draw, n_draws)``: the apportionment of growing houses."""
    house = F.sum("quota").over(_everything())
    rows = quotas.withColumns({"_all": house, "_n": F.count(F.lit(1)).over(_everything())}).where("_all > 0")
    rows = rows.withColumn("shard", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("_all") / shard_blocks).cast("long"))))
    rows = rows.withColumn("_house", F.least(F.col("shard") * shard_blocks, F.col("_all")))
    fair = F.col("quota") * F.col("_house") / F.col("_all")
    slack = F.col("quota") * F.col("_n") / F.col("_all") / 2 + 1
    low, high = F.greatest(F.lit(0), F.floor(fair - slack)), F.least(F.col("quota"), F.ceil(fair + slack))
    seated = _highest_quotients(rows, ["shard"], "_house", "quota", low, high)
    previous = F.coalesce(F.lag("_seats").over(Window.partitionBy("_src").orderBy("shard")), F.lit(0))
    return seated.select("shard", "_src", previous.alias("first_draw"), (F.col("_seats") - previous).alias("n_draws"))


def _permuted(quotas: DataFrame, seed: int) -> DataFrame:
    """Seeded permutation of a source's blocks: block b is drawn as number (a b + c) mod n."""
    n = F.greatest(F.col("n_blocks"), F.lit(1))
    a = F.coalesce(*[F.when(n % p != 0, F.lit(p)) for p in PRIMES]).cast("long")
    c = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "_src")), 1, 8), 16, 10).cast("long") % n
    return quotas.withColumns({"_a": a, "_c": c})


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``taken`` and ``draws``.

    ``draws`` lists the document's cuts by block: first word, number of words, times taken
    (0 to 2) and the first draw number of its block.  The prefix sums that place documents
    on their source's stream go over two levels of seeded buckets, so no task sees a source.
    """
    return carry(docs, ["doc_id", "text", "source"], RESULTS, lambda rows: _mixed(rows, block_words, share, seed))


def _mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    placed = _placed(docs, seed)
    inner = placed.groupBy("_src", "_outer", "_inner").agg(F.sum("size").alias("_words"))
    outer = inner.groupBy("_src", "_outer").agg(F.sum("_words").alias("_words"))
    up_to = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1])
    outer = outer.withColumn("_base", F.sum("_words").over(up_to("_src", "_outer")) - F.col("_words")).drop("_words")
    quotas = _permuted(
        source_quotas(source_targets(inner.groupBy("_src").agg(F.sum("_words").alias("source_size")), share), block_words), seed
    )
    inner = inner.withColumn("_before", F.sum("_words").over(up_to("_src", "_outer", "_inner")) - F.col("_words")).drop("_words")
    inner = inner.join(outer.join(quotas, "_src"), ["_src", "_outer"]).withColumn("_base", F.col("_base") + F.col("_before"))
    within = Window.partitionBy("_src", "_outer", "_inner").orderBy("_u", "doc_id", "size", F.xxhash64("text"))
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.withColumn("_end", F.sum("size").over(within)).join(inner.drop("_before"), ["_src", "_outer", "_inner"])
    rows = rows.withColumn("_end", F.col("_base") + F.col("_end")).withColumn("_start", F.col("_end") - F.col("size"))

    drawn = lambda b: (F.col("_a") * b + F.col("_c")) % F.col("n_blocks")
    first = lambda b: F.greatest(b * block_words, F.col("_start"))

    def cut(b):
        return F.struct(
            (first(b) - F.col("_start")).alias("first_word"),
            (F.least((b + 1) * block_words, F.col("_end")) - first(b)).alias("n_words"),
            (F.floor(F.col("quota") / F.col("n_blocks")) + (drawn(b) < F.col("quota") % F.col("n_blocks")).cast("long")).alias("times"),
            drawn(b).alias("draw"),
        )

    blocks = F.sequence(F.floor(F.col("_start") / block_words), F.floor((F.col("_end") - 1) / block_words))
    kind = "array<struct<first_word:bigint,n_words:bigint,times:bigint,draw:bigint>>"
    rows = rows.withColumn("draws", F.when(F.col("size") > 0, F.transform(blocks, cut)).otherwise(F.array()).cast(kind))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda x, d: x + d["n_words"] * d["times"])
    return rows.withColumn("taken", taken)


def mixed_texts(docs: DataFrame, block_words: int = BLOCK_WORDS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """The mix itself: per pass one row for each document that the pass takes words of.

    Columns are those of ``docs``; ``text`` holds the taken words with the blanks that followed
    them (the whole text where all of it is taken), and ``n_chars``, where present, its length.
    A document taken twice gives two rows; one not taken gives none.
    """
    pieces = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))

    def passed(k: int):
        parts = F.transform(
            F.filter("draws", lambda d: d["times"] >= k),
            lambda d: F.array_join(F.slice("_pieces", (d["first_word"] + 1).cast("int"), d["n_words"].cast("int")), ""),
        )
        whole = F.forall("draws", lambda d: d["times"] >= k)
        return F.when(whole, F.col("text")).otherwise(F.array_join(parts, ""))

    def body(rows: DataFrame) -> DataFrame:
        rows = _mixed(rows, block_words, share, seed).where("taken > 0").withColumn("_pieces", pieces)
        rows = rows.withColumn("text", F.explode(F.array(*[passed(k) for k in range(1, MOST + 1)]))).where("text <> ''")
        if "n_chars" not in rows.columns:
            return rows
        return rows.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))

    return carry(docs, ["doc_id", "text", "source", "n_chars"], [], body)
