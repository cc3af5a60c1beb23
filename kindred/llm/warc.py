"""WARC archives with a two-level capture index.

Pages are written as gzip members of WARC files, one record each, with payloads of
``DEDUP_BYTES`` and more stored once: the smallest page_id has the response, the others
revisit it.  Every record's capture line (reversed-host URL key, page_id, file, offset,
length) goes to an index: lines sorted by key, cut into compressed blocks of ``BLOCK_LINES``,
with a sparse directory of the blocks' first keys at the end of each index file.  A lookup
searches the list of index files, then a file's directory, by bisection, and fetches only the
blocks and then the records it needs by range reads.

Lines are ranged by (key, page_id), so captures of one URL may fill many index files; a
request for it goes to each of them.  The list of index files, one row per ``INDEX_BYTES`` or
task, is what the driver and every task hold.  Payloads are shuffled once, by page_id.

Defined cases: a NULL html is an empty payload; a NULL or broken URL has an empty host in its
key, blanks and signs outside ASCII in a key are percent-encoded; rows of equal page_id and
payload are all responses where theirs is the smallest id; a NULL page_id is never smallest
unless all ids of a payload are NULL, and then is a response; an empty table gives no file
and no row; other columns are not stored.  Files of failed attempts are never listed.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import files
from kindred.llm.expressions import only
from kindred.session import cut_lineage, fresh_folder, task_count

DEDUP_BYTES = 100
WARC_BYTES = 256 << 20
INDEX_BYTES = 64 << 20
BLOCK_LINES = 512
#: Neighbouring records are fetched together up to so many bytes.
READ_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"KCDX0001"
FOOTER = struct.Struct("<QI8s")
CAPTURES = "key string, page_id long, path string, offset long, length long"
INDEX = "path string, first_key string, last_key string"
KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def url_key(url: str | None) -> str:
    """Reversed-host key of a URL: ``com,example,www)/path?query``."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return quote(f")/{url}", safe="/?&=%,;:@+$!*'()~#[]")
    tail = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return quote(f"{','.join(reversed(host.split('.')))}{tail}){path}", safe="/?&=%,;:@+$!*'()~#[]")


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(uri: str) -> int | None:
    name = uri.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, whose length is that of the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~' + chr(39))}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        fields += [f"WARC-Refers-To: {_uri(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])


def parse_record(data: bytes) -> tuple:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, payload`` of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest, kind = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers_to = _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return _page_id(fields["WARC-Record-ID"]), size, digest, kind, refers_to, payload


def _footer(at: int, length: int) -> bytes:
    return FOOTER.pack(at, length, MAGIC)


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class _Parts:
    """Rolls files of one kind and keeps count of the bytes written."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.name, self.out, self.uri, self.size = (folder, stem, suffix), None, "", 0

    def put(self, data: bytes) -> int:
        if self.out is None:
            self.uri, self.size = files.new_name(*self.name), 0
            self.out = files.writer(self.uri)
        self.out.write(data)
        self.size += len(data)
        return self.size - len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_records(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record; a written table of captures (key, page_id, path, offset, length)."""
    pages = only(pages, "page_id", "url", "html")
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")), 256)
    told = pages.select("page_id", digest.alias("d"), F.octet_length(F.coalesce(F.col("html"), F.lit(""))).alias("n")).where(f"n >= {DEDUP_BYTES}")
    first = told.groupBy("d").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1 AND first IS NOT NULL")
    later = told.join(first, "d").where("page_id IS NULL OR page_id > first").select(F.col("page_id").alias("p"), F.col("d"), "first").distinct()
    rows = pages.select("page_id", "url", "html", digest.alias("digest"))
    rows = rows.join(later, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    rows = rows.select("page_id", "url", "html", F.col("first").alias("refers_to"), F.col("d").isNotNull().alias("revisit"))

    def write(batches):
        from pyspark import TaskContext

        out = _Parts(folder, f"part-{TaskContext.get().partitionId():06d}", ".warc.gz")
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to, revisit in zip(*(batch.column(i) for i in range(5))):
                page_id, url = page_id.as_py(), url.as_py()
                data = _member(record(page_id, url, (html.as_py() or "").encode("utf-8"), refers_to.as_py(), revisit.as_py()))
                if out.out is None:
                    info = b"software: kindred\r\nformat: WARC File Format 1.1\r\n"
                    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:part:{out.name[1]}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                    out.put(_member(head.encode() + info + b"\r\n\r\n"))
                rows.append((url_key(url), page_id, out.uri, out.put(data), len(data)))
                if out.size >= WARC_BYTES:
                    out.close()
            yield _batch(rows, CAPTURES)
        out.close()

    return cut_lineage(rows.mapInArrow(write, CAPTURES))


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Index of captures; a written table of its files: path, first_key, last_key."""

    def write(batches):
        from pyspark import TaskContext

        out = _Parts(folder, f"index-{TaskContext.get().partitionId():06d}", ".cdx")
        lines, directory, last, done = [], [], "", []

        def flush():
            if lines:
                data = zlib.compress("\n".join(x for _, x in lines).encode())
                directory.append((lines[0][0], out.put(data), len(data)))
                lines.clear()

        def close():
            flush()
            if directory:
                table = zlib.compress(json.dumps(directory).encode())
                at = out.put(table)
                out.put(_footer(at, len(table)))
                done.append((out.uri, directory[0][0], last))
                directory.clear()
                out.close()

        for batch in batches:
            for key, page_id, path, offset, length in zip(*(x.to_pylist() for x in batch.columns)):
                lines.append((key, f"{key} {json.dumps([page_id, path, offset, length])}"))
                last = key
                if len(lines) == BLOCK_LINES:
                    flush()
                    if out.size >= INDEX_BYTES:
                        close()
        close()
        yield _batch(done, INDEX)

    ranged = captures.repartitionByRange(task_count(captures.sparkSession), "key", "page_id").sortWithinPartitions("key", "page_id", "path", "offset")
    return cut_lineage(ranged.mapInArrow(write, INDEX))


class IndexFile:
    """Directory of one index file and its blocks on demand."""

    def __init__(self, uri: str):
        self.file = files.reader(uri)
        size = self.file.size()
        at, length, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a capture index: {uri}")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, at)))
        self.first_keys, self.held = [x[0] for x in self.directory], (-1, [], [])

    def block(self, i: int) -> tuple[list[str], list[str]]:
        """Keys and the rest of the lines of block ``i``; the last one fetched is kept."""
        if self.held[0] != i:
            _, offset, length = self.directory[i]
            lines = [x.split(" ", 1) for x in zlib.decompress(self.file.read_at(length, offset)).decode().split("\n")]
            self.held = (i, [x[0] for x in lines], [x[1] for x in lines])
        return self.held[1:]

    def captures(self, key: str):
        """``[page_id, path, offset, length]`` of every capture of a key."""
        i = max(0, bisect_left(self.first_keys, key) - 1)  # the key may begin in the block before
        while i < len(self.first_keys) and self.first_keys[i] <= key:
            keys, rest = self.block(i)
            for k in range(bisect_left(keys, key), bisect_right(keys, key)):
                yield json.loads(rest[k])
            i += 1


def lookup(index: DataFrame, urls: DataFrame) -> DataFrame:
    """Captures (key, page_id, path, offset, length) of all rows of ``urls(url)``, through the index."""
    listed = sorted((r["first_key"], r["last_key"], r["path"]) for r in index.collect())  # one row per index file
    last_keys, first_keys = [x[1] for x in listed], [x[0] for x in listed]

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(x.as_py()) for x in batch.column(0)], pa.string())], names=["key"])

    def route(batches):
        for batch in batches:
            found = [(listed[i][2], k) for k in batch.column(0).to_pylist() for i in range(bisect_left(last_keys, k), bisect_right(first_keys, k))]
            yield _batch(found, "file string, key string")

    def fetch(table: pa.Table) -> pa.Table:
        file = IndexFile(table["file"][0].as_py())
        rows = [(k, *x) for k in sorted(table["key"].to_pylist()) for x in file.captures(k)]
        return pa.Table.from_batches([_batch(rows, CAPTURES)])

    wanted = only(urls, "url").mapInArrow(keys, "key string").distinct()
    return wanted.mapInArrow(route, "file string, key string").groupBy("file").applyInArrow(fetch, CAPTURES)


def read_records(captures: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of captures by range reads, neighbours together: id, size, digest, type, refers_to."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads

    def read(batches):
        path, file = None, None
        for batch in batches:
            places, i = list(zip(*(x.to_pylist() for x in batch.columns))), 0
            while i < len(places):
                j = i + 1
                while j < len(places) and places[j][0] == places[i][0] and places[j][1] + places[j][2] - places[i][1] <= READ_BYTES:
                    j += 1
                if places[i][0] != path:
                    path = places[i][0]
                    file = files.reader(path)
                start = places[i][1]
                run = file.read_at(places[j - 1][1] + places[j - 1][2] - start, start)
                rows = [parse_record(zlib.decompress(run[o - start : o - start + n], 31))[: 5 + payloads] for _, o, n in places[i:j]]
                yield _batch(rows, schema)
                i = j

    placed = captures.select("path", "offset", "length").repartition(task_count(captures.sparkSession), "path")
    return placed.sortWithinPartitions("path", "offset").mapInArrow(read, schema)


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write pages and their index under ``folder``; the tables of captures and of index files."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    captures = write_records(pages, folder)
    return captures, write_index(captures, folder)
