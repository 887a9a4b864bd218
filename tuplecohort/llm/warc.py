"""WARC archives through a chunked record table.

A record table has one row per (record, chunk number)::

    record_id string, chunk_no int, n_chunks int, ..., data binary

Payloads longer than ``CHUNK`` bytes are spread over several rows, so no row,
writer or reader holds a whole record: the writer appends the chunks of a record
as they come, the reader walks a file with one buffer and emits a row per chunk.
Each row read carries the digest of the payload up to and including that chunk,
so the last chunk of a record has the digest of the whole payload.

Every record is a gzip member of its own (``.warc.gz``), compressed and read back as a
stream.  A record's id names its page and the first digits of its payload's digest.

Duplicates follow the WARC revisit profile: among records with equal payloads of
at least ``MIN_REVISIT`` bytes that with the smallest page_id is a ``response``,
the others are ``revisit`` records without a payload that name it.  A reader takes the
full size of a revisit's payload from a response with the same digest.

Archives go to a shared folder under names of their own per task attempt; only
names in the stored manifest are read, so lost executors and repeated attempts
do no harm.  A task starts a new file after ``FILE_BYTES``.

Defined cases: a null payload is empty; empty and short payloads are responses; a
null page_id counts as larger than any other and may not be referred to, so it is
a response when its payload has no smaller id; rows with equal ids and other payloads are
records of their own; repeated rows that share the smallest page_id are all responses (with
one record id); payloads of any length are written and read in chunks; an empty table gives no files and no rows.
Only ``page_id``, ``url`` and ``html`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bare, fresh_name, join_counted, open_folder, shared_folder, stored

CHUNK = 1 << 16
FILE_BYTES = 1 << 28
MIN_REVISIT = 100
_MANIFEST = "uri string, n_records bigint, n_bytes bigint"
_CHUNKS = ("uri string, record_no bigint, record_id string, page_id bigint, record_type string, refers_to string, "
           "chunk_no int, last boolean, digest_so_far string, data binary, stated_digest string")
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, record_type, refers_to (page_id of the response)."""
    p = bare(pages, "page_id", "url", "html")
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    p = p.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                 payload.alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")) \
         .withColumn("digest", F.sha2("payload", 256))
    # Only payloads that occur again get a row here; counting combines before its shuffle.
    seen = p.select("page_id", "digest", "payload_bytes").groupBy(F.col("digest").alias("a_digest")).agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.first("payload_bytes").alias("size"))
    seen = stored(seen, "warc-digests")
    total = seen.agg(F.sum("n")).first()[0] or 0
    again = seen.filter(f"size >= {min_bytes} and n > 1 and first_id is not null").select("a_digest", "n", "first_id")
    j = join_counted(p, "digest", again, "a_digest", "n", total)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return j.select("page_id", "url", "payload", "payload_bytes", "digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first_id")).alias("refers_to"))


def record_chunks(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The record table to write: the rows of a record follow each other in order; revisits have no payload."""
    length = F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes"))
    last = F.greatest(F.ceil(length / chunk), F.lit(1)).cast("int") - 1
    rows = records.withColumn("n_chunks", last + 1).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    data = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(
        F.expr(f"substring(payload, chunk_no * {chunk} + 1, {chunk})"))
    return rows.select("page_id", "url", "payload_bytes", "digest", "record_type", "refers_to", "n_chunks", "chunk_no",
                       data.alias("data"))


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest[:32]}>"


def named_page(name: str | None) -> int | None:
    """The page_id in a record's name."""
    page = name.removeprefix("<urn:page:").partition(":")[0] if name else "none"
    return None if page == "none" else int(page)


def _head(page_id, url, n_bytes, digest, kind, refers, stamp) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_name(page_id, digest)}",
             f"WARC-Date: {stamp}", f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: {record_name(refers, digest)}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if kind == 'revisit' else n_bytes}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _one_line(url: str | None) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def write_warc(chunks: DataFrame, name: str = "warc") -> DataFrame:
    """Write a record table (rows of a record adjacent and in order) as WARC files; returns the stored manifest."""
    folder = shared_folder(chunks.sparkSession, name)
    stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, files, uri, n_records, n_bytes = None, [], None, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                page_id, url, size, digest, kind, refers, n_chunks, chunk_no, data = row
                if chunk_no == 0:
                    if out is not None and n_bytes >= FILE_BYTES:
                        out.close()
                        files.append((uri, n_records, n_bytes))
                        out = None
                    if out is None:
                        where, base = open_folder(folder)
                        where.create_dir(base, recursive=True)
                        file = fresh_name("part", ".warc.gz")
                        uri, n_records, n_bytes = f"{folder}/{file}", 0, 0
                        out = where.open_output_stream(f"{base}/{file}", compression=None)
                    member, n_records = zlib.compressobj(1, zlib.DEFLATED, 31), n_records + 1
                    data = _head(page_id, url, size, digest, kind, refers, stamp) + data
                packed = member.compress(data)
                if chunk_no == n_chunks - 1:
                    packed += member.compress(b"\r\n\r\n") + member.flush()
                out.write(packed)
                n_bytes += len(packed)
        if out is not None:
            out.close()
            files.append((uri, n_records, n_bytes))
        cols = list(zip(*files)) if files else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
                                         names=["uri", "n_records", "n_bytes"])

    return stored(chunks.mapInArrow(write, _MANIFEST), name + "-manifest")


def walk_warc(source, chunk: int = CHUNK) -> Iterator[tuple[dict, int, bool, str, bytes]]:
    """(headers, chunk number, whether it is the last, digest so far, bytes) of a file; holds one chunk at a time."""
    buffer, at = b"", 0          # what was read, and the place in it

    def fill(n: int) -> bool:
        """Whether n bytes more are there; the buffer is cut only when more is read."""
        nonlocal buffer, at
        while len(buffer) - at < n:
            more = source.read(max(chunk, n))
            if not more:
                return False
            buffer, at = buffer[at:] + more, 0
        return True

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            if not fill(len(buffer) - at + 1):
                raise ValueError("a WARC header is cut short")
        first, *lines = buffer[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = end + 4
        left, nth, digest = int(head["content-length"]), 0, hashlib.sha256()
        while True:
            take = min(chunk, left)
            if not fill(take):
                raise ValueError("a WARC payload is cut short")
            data = buffer[at:at + take]
            at += take
            digest.update(data)
            left -= take
            yield head, nth, left == 0, digest.hexdigest(), data
            nth += 1
            if left == 0:
                break
        if not fill(4) or buffer[at:at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record has no end")
        at += 4


def read_warc(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The record table of the archives in a manifest: one row per record and chunk, with running digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_(),
                 pa.string(), pa.binary(), pa.string()]
        names = ["uri", "record_no", "record_id", "page_id", "record_type", "refers_to", "chunk_no", "last",
                 "digest_so_far", "data", "stated_digest"]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                where, path = open_folder(uri)
                rows, held, record_no = [], 0, -1
                with where.open_input_stream(path, compression=None) as file:
                    source = gzip.GzipFile(fileobj=file) if path.endswith(".gz") else file
                    for head, chunk_no, last, digest, data in walk_warc(source, chunk):
                        record_no += chunk_no == 0
                        ident = head["warc-record-id"]
                        rows.append((uri, record_no, ident, named_page(ident), head["warc-type"], head.get("warc-refers-to"),
                                     chunk_no, last, digest, data,
                                     head["warc-payload-digest"].removeprefix("sha256:")))
                        held += len(data) + 200
                        if held > 1 << 22:
                            yield made(rows)
                            rows, held = [], 0
                if rows:
                    yield made(rows)

    files = manifest.select("uri")
    return files.repartition(max(1, manifest.count())).mapInArrow(read, _CHUNKS)


def record_summary(chunks: DataFrame) -> DataFrame:
    """One row per record of a record table: payload_bytes and payload_digest of the full payload.

    A revisit has the digest that it states; its size is that of the responses with this digest.
    """
    r = chunks.groupBy("uri", "record_no").agg(
        F.first("page_id").alias("page_id"), F.first("record_type").alias("record_type"),
        F.first("refers_to").alias("name"), F.first("stated_digest").alias("stated_digest"),
        F.sum(F.octet_length("data")).cast("bigint").alias("payload_bytes"),
        F.max(F.when(F.col("last"), F.col("digest_so_far"))).alias("payload_digest"))
    page = F.regexp_extract("name", "^<urn:page:(-?[0-9]+):", 1)
    r = r.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.when(page != "", page.cast("bigint"))))
    r = stored(r, "warc-records")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    again = r.filter("record_type = 'revisit'").select("page_id", "stated_digest", "record_type", "refers_to")
    wanted = again.groupBy(F.col("stated_digest").alias("w_digest")).agg(F.count(F.lit(1)).alias("n"))
    found = r.filter("record_type = 'response'").join(wanted, F.col("payload_digest") == F.col("w_digest"), "inner") \
             .groupBy("w_digest").agg(F.first("n").alias("n"), F.first("payload_bytes").alias("payload_bytes"),
                                      F.first("payload_digest").alias("payload_digest"))
    found = stored(found, "warc-revisited")
    total = found.agg(F.sum("n")).first()[0] or 0
    again = join_counted(again, "stated_digest", found, "w_digest", "n", total)
    return r.filter("record_type = 'response'").select(*out).unionByName(again.select(*out))


def archive(pages: DataFrame) -> DataFrame:
    """Write one WARC record per page; returns the stored manifest of the files."""
    return write_warc(record_chunks(with_revisits(pages)))
