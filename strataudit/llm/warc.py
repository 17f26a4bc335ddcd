"""WARC archives written and read as a table of payload chunks."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm.common import kept, shared_dir

CHUNK = 1 << 16  # bytes of payload in a row
BATCH = 1 << 22  # bytes of payload in a batch of rows
# Fixed values of the format.
VERSION, DATE = b"WARC/1.0", "1970-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(rows: DataFrame, payload: str, size: int = CHUNK) -> DataFrame:
    """A row per ``size`` bytes of the binary column ``payload``, one at least: its other columns, ``chunk_no``,
    ``data``. A payload's chunks follow one another in order, and are cut off one at a time."""
    n = F.greatest(F.ceil(F.octet_length(payload) / size), F.lit(1)).cast("int")
    others = [c for c in rows.columns if c != payload]
    return rows.select(*others, payload, F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no")).select(
        *others, "chunk_no", F.substring(F.col(payload), F.col("chunk_no") * size + 1, F.lit(size)).alias("data"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, page_id, chunk_no, data) rows to one row per record; a record's state is a hash and a length."""
    now, size, sha = None, 0, None
    names = ["key", "page_id", "payload_bytes", "payload_digest"]
    for batch in batches:
        done = []
        for key, page, no, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if no == 0:
                if sha is not None:
                    done.append((*now, size, _base32(sha.digest())))
                now, size, sha = (key, page), 0, hashlib.sha1()
            sha.update(data)
            size += len(data)
        yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in done], schema=DIGESTS)
    if sha is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*now, size, _base32(sha.digest())), strict=True))], schema=DIGESTS)


DIGESTS = pa.schema([("key", pa.int64()), ("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``key`` (of the whole row), ``page_id`` as text, ``url`` and ``payload`` in UTF-8, null as empty."""
    return pages.select(F.xxhash64(id_col, url_col, payload_col).alias("key"), F.col(id_col).cast("string").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))


def planned(rows: DataFrame, id_type: str, least: int = 0) -> DataFrame:
    """What becomes of each record: ``key``, ``page_id``, payload length and digest, and ``refers_to``, null for a
    response. Of equal payloads of ``least`` bytes or more, the one with the smallest id is the response."""
    found = kept(chunked(rows.select("key", "page_id", "payload"), "payload")
                 .mapInArrow(_digested, "key bigint, page_id string, payload_bytes bigint, payload_digest string"))
    known = F.col("page_id").cast(id_type)
    first = (found.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
             .agg(F.min(known).alias("first")))
    joined = found.join(first, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & ~known.eqNullSafe(F.col("first"))
    return joined.select("key", "page_id", "payload_bytes", "payload_digest",
                         F.when(again, F.col("first").cast("string")).alias("refers_to")).dropDuplicates(["key"])


def _head(row: dict) -> bytes:
    lines = [("WARC-Type", "revisit" if row["refers_to"] is not None else "response"),
             ("WARC-Record-ID", f"<urn:record:{row['key'] & (2**64 - 1):016x}>"), ("WARC-Date", DATE),
             ("WARC-Target-URI", row["url"]), ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
             ("X-Page-ID", row["page_id"]), ("X-Payload-Length", row["payload_bytes"])]
    body = len(HTTP_HEAD)
    if row["refers_to"] is not None:
        lines += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", row["refers_to"])]
    else:
        body += row["payload_bytes"]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", body)]
    # A line break in a value would start another header.
    text = "".join(f"{k}: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', str(v))}\r\n" for k, v in lines if v is not None)
    return VERSION + b"\r\n" + text.encode() + b"\r\n" + HTTP_HEAD


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each attempt writes files of its own; only those of the attempt that succeeds get into the manifest.
        store, root = fs.FileSystem.from_uri(folder)
        out, path, pack, count, written = None, None, None, 0, 0

        def ended():
            out.write(pack.compress(b"\r\n\r\n") + pack.flush())

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": written}], schema=MANIFEST)

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if pack is not None:
                        ended()
                    if out is not None and written >= archive_bytes:
                        yield closed()
                        out = None
                    if out is None:
                        path, count, written = f"{root.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(path, compression=None)
                    pack = zlib.compressobj(wbits=31)  # a gzip member for each record
                    out.write(pack.compress(_head(row)))
                    count += 1
                out.write(pack.compress(row["data"]))
                written += len(row["data"])
        if pack is not None:
            ended()
            yield closed()

    return run


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", least: int = 0, archive_bytes: int = 1 << 28) -> DataFrame:
    """Write one record per row to gzip-compressed archives below ``folder``, by default a new one in the shared
    folder; returns the manifest: path, records and payload bytes of each archive.

    Payloads travel as chunks; digests and compression go on from chunk to chunk, so no task holds a record that Spark
    does not hold already. Null payloads are empty, a null id or address leaves its header out. Rows equal in all three
    columns are one response each and not revisits of one another; of rows that share the smallest id, all are
    responses. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    rows = records(pages, id_col, url_col, payload_col)
    plan = planned(rows, dict(pages.dtypes)[id_col], least)
    body = rows.select("key", "url", "payload").join(plan, "key").withColumn(
        "payload", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")))
    return kept(chunked(body, "payload").mapInArrow(_writer(folder, archive_bytes), "path string, records bigint, bytes bigint"))


CHUNKS = pa.schema([("record_id", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.string()), ("stated_bytes", pa.int64()), ("stated_digest", pa.string()),
                    ("chunk_no", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()),
                    ("digest_so_far", pa.string()), ("last", pa.bool_())])


def _records_of(stream: io.BufferedReader, chunk: int, keep: bool) -> Iterator[dict]:
    while line := stream.readline():
        if not line.strip():
            continue
        if line.strip() != VERSION:
            raise ValueError(f"not a record: {line[:80]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        left = int(head["content-length"])
        while left > 0:  # the header of the transfer
            line = stream.readline(left)
            left -= len(line)
            if not line.strip():
                break
        row = {"record_id": head["warc-record-id"].strip("<>"), "page_id": head.get("x-page-id"), "url": head.get("warc-target-uri"),
               "record_type": head["warc-type"], "refers_to": head.get("x-refers-to-page-id"),
               "stated_bytes": int(head["x-payload-length"]), "stated_digest": head["warc-payload-digest"].removeprefix("sha1:")}
        sha, size, no = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise EOFError(f"{row['record_id']} ends after {size + len(data)} bytes")
            left -= len(data)
            size += len(data)
            sha.update(data)
            yield row | {"chunk_no": no, "data": data if keep else None, "bytes_so_far": size,
                         "digest_so_far": _base32(sha.digest()), "last": left == 0}
            no += 1
            if not left:
                break


def read(manifest: DataFrame, folder: str | None = None, chunk: int = CHUNK, keep_data: bool = True, tasks: int = 1 << 16) -> DataFrame:
    """The chunk table of the archives of a manifest: a row per record and chunk number, with the payload bytes, the
    length and digest of the payload up to this chunk, and whether it is the last. Archives are read side by side, in ``tasks`` tasks at most.

    ``keep_data=False`` leaves the bytes out once they are digested. A revisit has one empty chunk and states the length
    and digest of the payload that it refers to.
    """
    folder = folder or shared_dir(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain:
                    for row in _records_of(io.BufferedReader(plain, 1 << 18), chunk, keep_data):
                        rows.append(row)
                        held += 500 + len(row["data"] or b"")
                        if held >= BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema=CHUNKS)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=CHUNKS)

    # A number of its own for each archive: adaptive execution would draw paths, which are short, together into one task.
    tasks = min(max(1, manifest.count()), tasks)
    return manifest.select("path").repartitionByRange(tasks, "path").mapInArrow(
        run, "record_id string, page_id string, url string, record_type string, refers_to string, stated_bytes bigint, "
             "stated_digest string, chunk_no int, data binary, bytes_so_far bigint, digest_so_far string, last boolean")
