"""WARC archives: writer, normaliser of monolithic gzip streams, reader.

Some tools gzip a whole archive as one stream, which can only be read from the
front.  :func:`normalise` inflates such a stream once, rewrites every record
as a gzip member of its own and writes a sidecar index of the members'
offsets, after which records can be read one by one (:func:`read`).

Files are written by tasks through ``pyarrow.fs`` to the folder the caller
names (storage that all executors see), under names that no other attempt
uses; the tables returned by the writers list the files of the attempts that
Spark committed, so a retried or speculative task leaves no record twice.
Archives roll over at a size limit, and every reader streams: a task holds
one record at a time.

Defined results: a null payload is an empty one; a null identifier gives a
record with a random identifier; a null URL is ``urn:x-no-url``; control characters
in URLs are percent-encoded.  Among equal payloads of at least
``REVISIT_BYTES``, the rows with the largest identifier are responses
(repeated rows with that identifier all are), rows without identifier revisit
it, and a group without any identifier is all responses.  Empty tables give
no archives and no records; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import short_batches
from lakemart.session import cut_lineage

REVISIT_BYTES = 1000            # smaller payloads are always stored in full
ARCHIVE_BYTES = 64 << 20        # uncompressed bytes after which an archive is closed
CHUNK = 1 << 20
LEVEL = 6                       # of gzip
PAGE = "urn:x-page:"            # record identifiers of rows with an identifier
GZIP = 31                       # zlib's window bits for the gzip format

FILES = "file string, records long, bytes long"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _create(uri: str):
    where, path = _filesystem(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return where.open_output_stream(path, compression=None)


# ------------------------------------------------------------- records

def record_bytes(page_id, url: str | None, payload: bytes, refers_to, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, with the length of
    the full payload, and leaves the payload out."""
    digest = hashlib.sha1(payload).hexdigest()
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:x-no-url"
    name = f"urn:uuid:{uuid.uuid4()}" if page_id is None else f"{PAGE}{page_id}"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{PAGE}{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def page_of(record_id: str | None) -> int | None:
    name = (record_id or "").strip("<>")
    return int(name.removeprefix(PAGE)) if name.startswith(PAGE) else None


def parse(record: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    h = headers(head)
    block = rest[:int(h["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response":
        if hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload of record {h.get('warc-record-id')} does not match its digest")
        size = len(body)
    else:
        size, body = int(headers(http)["content-length"]), None
    return {"page_id": page_of(h.get("warc-record-id")), "url": h.get("warc-target-uri"),
            "record_type": kind, "payload_bytes": size, "payload_digest": digest,
            "refers_to": page_of(h.get("warc-refers-to")),
            "payload": body}


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Plain bytes of a gzip stream of one or more members."""
    d = zlib.decompressobj(GZIP)
    for data in chunks:
        while data:
            out = d.decompress(data, CHUNK)
            if out:
                yield out
            if d.eof:
                data, d = d.unused_data, zlib.decompressobj(GZIP)
            else:
                data = d.unconsumed_tail
                if not data and not out:
                    break


def records(plain: Iterator[bytes]) -> Iterator[bytes]:
    """Cut a plain WARC stream into records, one at a time."""
    held, need = bytearray(), None
    for piece in plain:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


# ------------------------------------------------------------- writing

def _chunks(uri: str) -> Iterator[bytes]:
    where, path = _filesystem(uri)
    with where.open_input_stream(path, compression=None) as f:
        while data := f.read(CHUNK):
            yield data


def _file_rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.int64()), pa.array(c, pa.int64())],
                                      names=["file", "records", "bytes"])


def write_monolithic(df: DataFrame, folder: str, level: int = LEVEL, roll: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows (page_id, url, payload, refers_to) as archives that are one
    gzip stream each; returns the committed files."""

    def run(batches):
        out, pack, uri, n, size, total = None, None, None, 0, 0, 0

        def close():
            tail = pack.flush()
            out.write(tail)
            out.close()
            return _file_rows([(uri, n, total + len(tail))])

        for b in batches:
            for row in b.to_pylist():
                if out is None:
                    uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, pack, n, size, total = _create(uri), zlib.compressobj(level, zlib.DEFLATED, GZIP), 0, 0, 0
                data = record_bytes(row["page_id"], row["url"], row["payload"], row["refers_to"])
                packed = pack.compress(data)
                out.write(packed)
                n, size, total = n + 1, size + len(data), total + len(packed)
                if size >= roll:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return cut_lineage(df.select("page_id", "url", "payload", "refers_to").mapInArrow(run, FILES), "warc-files")


def _one_file_per_task(files: DataFrame) -> DataFrame:
    # the number of archives follows their bytes; each is a few dozen MB
    return files.select("file").repartition(max(1, files.count()), "file")


def normalise(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite archives with one gzip member per record below ``folder``, each
    with a sidecar index ``<archive>.idx`` (JSON lines: offset, length, type,
    record identifier); returns the committed files."""

    def run(batches):
        for b in batches:
            for source in b.column(0).to_pylist():
                uri, n, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                with _create(uri) as out, _create(uri + ".idx") as index:
                    for record in records(inflate(_chunks(source))):
                        pack = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        member = pack.compress(record) + pack.flush()
                        h = headers(record.partition(b"\r\n\r\n")[0])
                        index.write((json.dumps({"offset": offset, "length": len(member), "type": h["warc-type"],
                                                 "record_id": h.get("warc-record-id")}) + "\n").encode())
                        out.write(member)
                        n, offset = n + 1, offset + len(member)
                yield _file_rows([(uri, n, offset)])

    return cut_lineage(_one_file_per_task(files).mapInArrow(run, FILES), "warc-normal")


def index_lines(uri: str) -> Iterator[dict]:
    rest = b""
    for data in _chunks(uri + ".idx"):
        *lines, rest = (rest + data).split(b"\n")
        yield from map(json.loads, lines)


def read_member(handle, offset: int, length: int) -> bytes:
    """One record of a normalised archive, by its place in the index."""
    handle.seek(offset)
    return zlib.decompress(handle.read(length), GZIP)


RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long")


def read(files: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of normalised archives, read member by member through their
    indexes; ``payloads`` adds the payload (null for revisits)."""
    schema = RECORDS + (", payload binary" if payloads else "")
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
             "payload_digest": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if payloads else {})

    def to_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], names=list(kinds))

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                where, path = _filesystem(uri)
                with where.open_input_file(path) as handle:
                    rows, held = [], 0
                    for entry in index_lines(uri):
                        r = parse(read_member(handle, entry["offset"], entry["length"]))
                        rows.append(r if payloads else r | {"payload": None})
                        held += 300 + (r["payload_bytes"] if payloads else 0)
                        if held > 4 * CHUNK:
                            yield to_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield to_batch(rows)

    return _one_file_per_task(files).mapInArrow(run, schema)


# ------------------------------------------------------------- revisits

def with_revisits(df: DataFrame, id_col: str, url_col: str, text_col: str,
                  least: int = REVISIT_BYTES) -> DataFrame:
    """Rows (page_id, url, payload, refers_to) to be written.  Only groups of
    at least two equal payloads are joined back, by length and SHA-256."""
    short_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("payload"))
    large = F.octet_length("payload") >= least
    groups = (rows.filter(large).groupBy(F.sha2("payload", 256).alias("key"), F.octet_length("payload").alias("size"))
              .agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
              .filter("n > 1 AND keep IS NOT NULL").select("key", "size", "keep"))
    groups = cut_lineage(groups, "revisits")
    # small payloads match nothing; their keys are spread, not null
    key = F.when(large, F.sha2("payload", 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    rows = rows.withColumn("key", key).withColumn("size", F.octet_length("payload"))
    return rows.join(groups, ["key", "size"], "left").select(
        "page_id", "url", "payload",
        F.when(F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to"))


def round_trip(df: DataFrame, id_col: str, url_col: str, text_col: str, folder: str) -> DataFrame:
    """Write ``df`` as monolithic archives, normalise them, read them back."""
    written = write_monolithic(with_revisits(df, id_col, url_col, text_col), f"{folder}/mono")
    return read(normalise(written, f"{folder}/members"))
