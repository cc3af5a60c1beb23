"""Feature matrix, standardisation, PCA, text vectors and blended vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, PCAModel, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.columns import as_double, quoted
from kindred.functions.constants import MODEL_FEATURES
from kindred.functions.text import profile_sentence
from kindred.functions.vectors import l2_normalise
from kindred.session import cut_lineage, shuffled, spread

TEXT_DIMS = 384
#: Terms whose buckets a task keeps, and vectors that it makes at a time.
KNOWN_TERMS, VECTORS_AT_ONCE = 400_000, 2048


# ----------------------------------------------------------- statistics vectors


def feature_columns(df: DataFrame, features: list[str] = MODEL_FEATURES) -> list[Column]:
    """Features in fixed order; an absent column and an unreadable value are 0."""
    return [
        (F.coalesce(as_double(quoted(f)), F.lit(0.0)) if f in df.columns else F.lit(0.0)).alias(f) for f in features
    ]


def feature_moments(df: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """One row with mean and population standard deviation (0 becomes 1) per feature."""
    flat = df.select(*feature_columns(df, features))
    stats = []
    for f in features:
        c = F.col(quoted(f))
        width = F.stddev_pop(c)
        stats.append(F.struct(F.lit(f).alias("feature"), F.avg(c).alias("mean"), F.when(width == 0, 1.0).otherwise(width).alias("scale")))
    return flat.agg(F.array(*stats).alias("moments"))


def standardise(df: DataFrame, moments: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Add ``scaled``: features standardised by fitted moments.

    The fitted row (two numbers per feature) becomes literals of the plan.
    """
    fitted = {m["feature"]: m for m in moments.first()["moments"]}
    cells = [
        (value - F.lit(fitted[f]["mean"])) / F.lit(fitted[f]["scale"])
        for f, value in zip(features, feature_columns(df, features))
    ]
    return df.withColumn("scaled", F.array(*cells))


def fit_pca(standardised: DataFrame, n_components: int, n_features: int = len(MODEL_FEATURES)) -> PCAModel:
    """PCA of the ``scaled`` column of ``n_features`` entries, to which ``n_components`` is clamped."""
    rows = standardised.select(array_to_vector("scaled").alias("scaled_vec"))
    return PCA(k=min(n_components, n_features), inputCol="scaled_vec", outputCol="reduced_vec").fit(rows)


def apply_pca(standardised: DataFrame, model: PCAModel) -> DataFrame:
    """Add ``stat``: component scores of each row."""
    out = model.transform(standardised.withColumn("scaled_vec", array_to_vector("scaled")))
    return out.withColumn("stat", vector_to_array("reduced_vec")).drop("scaled_vec", "reduced_vec")


def save_embedder(moments: DataFrame, pca: PCAModel | None, path: str) -> None:
    """Persist a fitted embedder: moments as Parquet, PCA in ML format."""
    moments.write.mode("overwrite").parquet(f"{path}/moments")
    if pca is not None:
        pca.write().overwrite().save(f"{path}/pca")


def load_embedder(spark, path: str, reduced: bool = True) -> tuple[DataFrame, PCAModel | None]:
    return spark.read.parquet(f"{path}/moments"), PCAModel.load(f"{path}/pca") if reduced else None


def transform_rows(df: DataFrame, moments: DataFrame, pca: PCAModel | None, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Statistics vector ``stat`` of new rows under a fitted embedder."""
    scaled = standardise(df, moments, features)
    return apply_pca(scaled, pca) if pca is not None else scaled.withColumn("stat", F.col("scaled"))


# ----------------------------------------------------------------- text vectors


def text_pipeline(text_col: str = "profile", dims: int = TEXT_DIMS) -> Pipeline:
    """Hashed TF-IDF, unit length, with the dimension of a small sentence encoder."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"[^\p{L}\p{N}.]+"),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dims),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(inputCol="_tfidf", outputCol="_unit"),
        ]
    )


def encode_text(df: DataFrame, model: PipelineModel, out: str = "text") -> DataFrame:
    encoded = model.transform(df).withColumn(out, vector_to_array("_unit", "float32"))
    return encoded.drop("_tokens", "_tf", "_tfidf", "_unit")


TERM = r"[\p{L}\p{N}.]+"


def _term_counts(df: DataFrame, key: str, text_col: str, dims: int) -> DataFrame:
    """``(key, bucket, tf)``; terms fall into buckets by their digest."""
    terms = F.regexp_extract_all(F.lower(text_col), F.lit(TERM), F.lit(0))
    bucket = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long") % dims
    return spread(df.select(key, text_col), key).select(key, F.explode(terms).alias("term")).groupBy(key, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("tf"))


def bucket_idf(df: DataFrame, key: str, text_col: str = "profile", dims: int = TEXT_DIMS) -> DataFrame:
    """``(bucket, idf)``: at most ``dims`` rows, counted over all rows of ``df``."""
    return _idf(df, _term_counts(df, key, text_col, dims))


def _idf(df: DataFrame, counts: DataFrame) -> DataFrame:
    n = df.agg(F.count(F.lit(1))).scalar()
    seen = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    return seen.select("bucket", F.log((n + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def bucket_vectors(df: DataFrame, idf: DataFrame, key: str, text_col: str = "profile", dims: int = TEXT_DIMS, out: str = "text") -> DataFrame:
    """Unit vectors of term counts in digest buckets, weighed by ``idf``: the encoder that SQL can repeat.

    A row without a weighed term gets a zero vector.
    """
    return _vectors(df, _term_counts(df, key, text_col, dims), idf, key, dims, out)


def bucket_encode(df: DataFrame, key: str, text_col: str = "profile", dims: int = TEXT_DIMS, out: str = "text") -> tuple[DataFrame, DataFrame]:
    """:func:`bucket_idf` of ``df`` and its :func:`bucket_vectors`, both written; terms are cut and counted once.

    Counts of a text are one row, two arrays; no term is ever a row.
    """
    counted = cut_lineage(_counted(df, key, text_col, dims))
    idf = cut_lineage(_idf(df, counted.select(F.explode("buckets").alias("bucket"))))
    weights = np.zeros(dims)
    for r in idf.collect():  # one number per bucket
        weights[r["bucket"]] = r["idf"]
    return idf, cut_lineage(df.drop(text_col).join(shuffled(_weighed(counted, weights, key, out)), key, "left").withColumn(
        out, F.coalesce(out, F.array_repeat(F.lit(0.0), dims))
    ))


def _counted(df: DataFrame, key: str, text_col: str, dims: int) -> DataFrame:
    """``(key, buckets, counts)``: the counts of :func:`_term_counts`, one row per key with a term."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    terms = F.regexp_extract_all(F.lower(text_col), F.lit(TERM), F.lit(0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            lists = batch["terms"]
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
            coded = pc.list_flatten(lists).dictionary_encode()
            words = coded.dictionary.to_pylist()
            if len(known) > KNOWN_TERMS:
                known.clear()
            known.update((w, int.from_bytes(hashlib.md5(w.encode()).digest()[:4]) % dims) for w in words if w not in known)
            number = np.fromiter((known[w] for w in words), np.int64, len(words))
            some = sizes > 0
            place = np.repeat(np.cumsum(some) - 1, sizes) * dims + number[coded.indices.to_numpy()]
            counts = np.bincount(place)
            places = np.flatnonzero(counts)
            yield _sparse(batch[key].filter(pa.array(some)), places, counts[places], dims, schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one key, which follow one another, become one."""
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            keys = table[key].combine_chunks()
            new = np.r_[True, ~_same_as_before(keys)]
            at = np.cumsum(new) - 1
            buckets, counts = (table[c].combine_chunks() for c in ("buckets", "counts"))
            place = np.repeat(at, np.asarray(pc.list_value_length(buckets))) * dims + pc.list_flatten(buckets).to_numpy()
            places, back = np.unique(place, return_inverse=True)
            total = np.zeros(len(places), np.int64)
            np.add.at(total, back, pc.list_flatten(counts).to_numpy())
            done = _sparse(keys.filter(pa.array(new)), places, total, dims, schema)
            held = done.slice(done.num_rows - 1)  # its key may go on in the next batch
            if done.num_rows > 1:
                yield done.slice(0, done.num_rows - 1)
        if held is not None:
            yield held

    cut = df.select(key, terms.alias("terms"))  # a filter on the terms would cut them twice
    return spread(cut.mapInArrow(count, schema), key).sortWithinPartitions(key).mapInArrow(merge, schema)


def _same_as_before(keys: pa.Array) -> np.ndarray:
    """Whether each key but the first equals the one before it; an unknown key equals an unknown key."""
    a, b = keys[1:], keys[:-1]
    return np.asarray(pc.fill_null(pc.equal(a, b), False) if not keys.null_count else pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))))


def _sparse(keys: pa.Array, places: np.ndarray, counts: np.ndarray, dims: int, schema: T.StructType) -> pa.RecordBatch:
    """Rows ``(key, buckets, counts)`` of sorted places ``row * dims + bucket``."""
    row, bucket = np.divmod(places, dims)
    bounds = pa.array(np.searchsorted(row, np.arange(len(keys) + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (bucket.astype(np.int32), counts.astype(np.int64))]
    return pa.record_batch([keys, *lists], names=schema.names)


def _weighed(counted: DataFrame, weights: np.ndarray, key: str, out: str) -> DataFrame:
    """Unit vectors ``out`` of sparse counts."""
    schema = T.StructType([counted.schema[key], T.StructField(out, T.ArrayType(T.DoubleType()))])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, VECTORS_AT_ONCE):
                batch = whole.slice(start, VECTORS_AT_ONCE)
                bucket = pc.list_flatten(batch["buckets"]).to_numpy().astype(np.int64)
                row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch["buckets"])))
                rows = np.zeros((batch.num_rows, len(weights)))
                rows[row, bucket] = pc.list_flatten(batch["counts"]).to_numpy() * weights[bucket]
                norm = np.sqrt((rows * rows).cumsum(axis=1)[:, -1])
                rows /= np.where(norm == 0, 1.0, norm)[:, None]
                bounds = pa.array(np.arange(0, rows.size + 1, len(weights), dtype=np.int32))
                yield pa.record_batch([batch[key], pa.ListArray.from_arrays(bounds, pa.array(rows.ravel()))], names=schema.names)

    return counted.where(F.col(key).isNotNull()).mapInArrow(weigh, schema)


def _vectors(df: DataFrame, counts: DataFrame, idf: DataFrame, key: str, dims: int, out: str) -> DataFrame:
    weighed = counts.join(F.broadcast(idf), "bucket").select(key, "bucket", (F.col("tf") * F.col("idf")).alias("w"))
    held = weighed.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "w"))).alias("_held"))
    spots = F.sequence(F.lit(0).cast("long"), F.lit(dims - 1).cast("long"))
    vector = F.transform(spots, lambda i: F.coalesce(F.try_element_at("_held", i), F.lit(0.0)))
    empty = F.transform(spots, lambda i: F.lit(0.0))
    return df.join(shuffled(held), key, "left").withColumn(out, F.when(F.col("_held").isNull(), empty).otherwise(l2_normalise(vector))).drop("_held")


def with_profile_text(df: DataFrame) -> DataFrame:
    return df.withColumn("profile", profile_sentence(df))


# -------------------------------------------------------------- blended vectors


def unit_blocks(df: DataFrame, blocks: list[str]) -> DataFrame:
    """Each named vector column at unit length; a zero vector stays zero."""
    return df.withColumns({b: l2_normalise(F.col(b)) for b in blocks})


def build_embeddings(
    df: DataFrame,
    method: str = "pca",
    n_components: int = 32,
    features: list[str] = MODEL_FEATURES,
    encoder: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(row_id, player, stat, text)`` with both blocks at unit length.

    The blend weight is a score-time parameter, so no blended copy is built.
    ``encoder`` turns a frame with a ``profile`` column into one with ``text``.
    """
    if method not in ("pca", "none"):
        raise ValueError(f"unknown method {method!r}")
    moments = feature_moments(df, features)
    scaled = standardise(df, moments, features)
    stat = apply_pca(scaled, fit_pca(scaled, n_components, len(features))) if method == "pca" else scaled.withColumn("stat", F.col("scaled"))
    profiled = with_profile_text(stat)
    encoded = encoder(profiled) if encoder else encode_text(profiled, text_pipeline().fit(profiled))
    return unit_blocks(encoded.select("row_id", "player", "stat", "text"), ["stat", "text"])
