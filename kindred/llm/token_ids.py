"""Token ids as binary files with a shared zstandard dictionary.

Documents are ranged by doc_id, encoded, and written as shards.  A shard holds one zstandard
frame per document, compressed alone with a dictionary that all shards share, so a short
document costs few bytes and is read alone.

    shard       magic, SHA-256 of the dictionary, frames, index, footer
    index       per document, in columns: doc_id (int64), offset (uint64), length and ids (uint32)
    footer      number of documents (uint32), offset of the index (uint64), magic
    dictionary  a file of its own beside the shards

Ids are little-endian unsigned 16-bit in a frame where the vocabulary allows, else 32-bit.
The dictionary is trained on a bounded sample (about ``SAMPLE_DOCS`` documents chosen by hash,
never over twice as many, ``SAMPLE_CHARS`` characters of each from a place chosen by hash); every document is encoded whole.  A shard is closed at
``SHARD_BYTES``, and its index is all that a task keeps in memory.

Defined cases: a NULL text counts as empty and gives the end id alone; equal doc_ids are
written side by side, in order of their text's hash; a NULL doc_id is written first, as the
smallest integer, and read back as NULL; an empty table gives no shard and no row; other
columns are not stored.  A lost executor's shards are written anew under other names.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import files
from kindred.llm.expressions import only
from kindred.llm.pieces import AgingCache, by_ranks, grouped, latin
from kindred.session import cut_lineage, fresh_folder, task_count

MAGIC = b"KIDS0001"
END_ID = 2
SAMPLE_DOCS, SAMPLE_CHARS = 1024, 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3
SHARD_BYTES = 64 << 20
#: Bytes that a reader fetches at once.
READ_BYTES = 4 << 20
NO_ID = -(1 << 63)
FOOTER = struct.Struct("<IQ8s")
_MADE: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts as unsigned bytes of a vocabulary file, as the tokenizers library encodes them.

    Texts of Latin letters without an added token's name go by ranks, which gives the same ids
    several times as fast; others go to the library by pieces, new ones only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.kind = "I" if library.get_vocab_size() > 1 << 16 else "H"
        self.width = array(self.kind).itemsize
        self.cache = AgingCache(lambda pieces: [array(self.kind, x.ids).tobytes() for x in library.encode_batch_fast(pieces, add_special_tokens=False)])
        self.ranks = by_ranks(path)
        names = [x.content for x in library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, names))).search if names else lambda text: None

    def __call__(self, texts: list[str]) -> list[bytes]:
        quick = [self.ranks is not None and latin(t) and not self.added(t) for t in texts]
        others = iter(self.cache([t for t, q in zip(texts, quick) if not q]))
        return [array(self.kind, self.ranks.encode_ordinary(t)).tobytes() if q else next(others) for t, q in zip(texts, quick)]


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _MADE:
        _MADE[path] = Encoder(path)
    return _MADE[path]


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """Dictionary for serialized ids from a bounded sample; empty where the sample is too small."""
    texts = docs.where("text IS NOT NULL")
    one_in, order = max(1, texts.count() // SAMPLE_DOCS), F.xxhash64("doc_id", "text")
    length = F.char_length("text")
    start = F.when(length > SAMPLE_CHARS, F.pmod(F.xxhash64(F.lit("slice"), "doc_id", "text"), length - SAMPLE_CHARS + 1)).otherwise(0) + 1
    sample = texts.where(F.pmod(order, F.lit(one_in)) == 0).select(order.alias("h"), F.substr("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
    sample = sample.orderBy("h", "text").limit(2 * SAMPLE_DOCS)  # about SAMPLE_DOCS unless one row is repeated very often

    def train(batches):
        encode, samples = encoder(path), []
        for batch in batches:
            for _, texts in grouped(batch, 1):
                samples += [x for x in encode(texts) if len(x) >= 8]
        try:
            trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 10), samples).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too little to learn from
            trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": [trained]})

    trained = sample.coalesce(1).mapInArrow(train, "dictionary binary").first()
    return bytes(trained["dictionary"]) if trained else b""


class ShardWriter:
    def __init__(self, uri: str, digest: bytes):
        self.uri, self.out, self.size, self.index = uri, files.writer(uri), 0, []
        self._put(MAGIC + digest)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, doc_id: int, frame: bytes, n_ids: int) -> None:
        self.index.append((doc_id, self.size, len(frame), n_ids))
        self._put(frame)

    def close(self) -> tuple[str, int, int]:
        """Path, number of documents and number of ids."""
        at = self.size
        for column, kind in zip(zip(*self.index), ("<i8", "<u8", "<u4", "<u4")):
            self._put(np.array(column, dtype=kind).tobytes())
        self._put(FOOTER.pack(len(self.index), at, MAGIC))
        self.out.close()
        return self.uri, len(self.index), sum(x[3] for x in self.index)


class ShardReader:
    """One shard; documents are fetched by place, alone or in runs."""

    def __init__(self, uri: str, dictionary: bytes, width: int):
        self.file = files.reader(uri)
        size = self.file.size()
        n, at, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        head = self.file.read_at(len(MAGIC) + 32, 0)
        if magic != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"not a shard of token ids: {uri}")
        if head[len(MAGIC) :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"the dictionary is not the one {uri} was written with")
        index, self.columns, done = self.file.read_at(n * 24, at), [], 0
        for kind in ("<i8", "<u8", "<u4", "<u4"):
            self.columns.append(np.frombuffer(index, dtype=kind, count=n, offset=done))
            done += n * int(kind[-1])
        self.ids, self.offsets, self.lengths, self.counts = self.columns
        self.width, self.zstd = width, _decompressor(dictionary)

    def document(self, place: int) -> np.ndarray:
        """Ids of the document at ``place``, by one range read."""
        return self._ids(self.file.read_at(int(self.lengths[place]), int(self.offsets[place])))

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.zstd.decompress(frame), dtype=f"<u{self.width}").astype("<u4")

    def __iter__(self):
        """Ids of all documents in order, fetched in runs of about ``READ_BYTES``."""
        place, n = 0, len(self.ids)
        while place < n:
            start = int(self.offsets[place])
            stop = max(place + 1, int(np.searchsorted(self.offsets, start + READ_BYTES)))
            run = self.file.read_at(int(self.offsets[stop - 1] + self.lengths[stop - 1]) - start, start)
            for i in range(place, stop):
                at = int(self.offsets[i]) - start
                yield self._ids(run[at : at + int(self.lengths[i])])
            place = stop


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_dict_id=False, **given)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))


def write_token_ids(docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write shards and return their manifest: part, shard, path, n_docs, n_tokens, dictionary.

    ``folder`` defaults to a new one in the shared folder.  The manifest is a written table,
    and the only list of valid shards.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "token-ids")
    docs = only(docs, "doc_id", "text")
    dictionary = train_dictionary(docs, path)
    digest = hashlib.sha256(dictionary).digest()
    kept = f"{folder}/dictionary-{digest.hex()}.zdict"
    with files.writer(kept) as out:
        out.write(dictionary)

    def write(batches):
        from pyspark import TaskContext

        encode, zstd, part = encoder(path), _compressor(dictionary), TaskContext.get().partitionId()
        end = end_id.to_bytes(encode.width, "little")
        done, shard = [], None
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_pylist()
            for start, texts in grouped(batch, 1):
                for doc_id, x in zip(ids[start:], encode(texts)):
                    shard = shard or ShardWriter(files.new_name(folder, f"part-{part:06d}-{len(done):06d}", ".kids"), digest)
                    shard.add(doc_id, zstd.compress(x + end), len(x) // encode.width + 1)
                    if shard.size >= SHARD_BYTES:
                        done.append(shard.close())
                        shard = None
        if shard:
            done.append(shard.close())
        columns = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * len(done), pa.int64()), "shard": pa.array(range(len(done)), pa.int64()),
            "path": pa.array(columns[0], pa.string()), "n_docs": pa.array(columns[1], pa.int64()), "n_tokens": pa.array(columns[2], pa.int64()),
        })

    ranged = docs.select("doc_id", "text").repartitionByRange(task_count(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = ranged.mapInArrow(write, "part long, shard long, path string, n_docs long, n_tokens long")
    return cut_lineage(manifest).withColumn("dictionary", F.lit(kept))


def shard_starts(manifest: DataFrame) -> DataFrame:
    """Manifest with ``start``: ids in all shards before.  Sums go by part first (one row per task)."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.withColumn("_before", F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).drop("_n")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return manifest.withColumn("_inside", inside).join(parts, "part").withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def read_token_ids(manifest: DataFrame, width: int, ids: bool = False) -> DataFrame:
    """Documents of the shards: doc_id, start, n_tokens, ids_crc32 and, by choice, ``ids``."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + ids]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.list_(pa.int64()) if n == "ids" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names
        )

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with files.reader(row["dictionary"]) as f:
                    dictionary = f.read()
                shard, start, rows, held = ShardReader(row["path"], dictionary, width), row["start"], [], 0
                for doc_id, x in zip(shard.ids.tolist(), shard):
                    crc = zlib.crc32(x.tobytes())
                    rows.append((None if doc_id == NO_ID else doc_id, start, len(x), crc, *([x.astype("<i8")] if ids else [])))
                    start, held = start + len(x), held + len(x) * ids + 8
                    if held > 1_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    listed = shard_starts(manifest).select("path", "dictionary", "start")
    return listed.repartition(task_count(manifest.sparkSession), "path").mapInArrow(read, schema)


def id_width(path: str) -> int:
    """Bytes per id in the shards of a vocabulary file."""
    return encoder(path).width
