"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; the bundle's index maps each record
to its frame and to its offset and length within the decompressed frame, and a
footer seek table maps frames to the file (:mod:`tidemark.llm.seekable`). One
record costs its frame alone.

A page is written as a ``response`` record (HTTP header and payload). Of pages
with equal payloads of at least ``SMALLEST_REVISIT`` bytes only that with the
smallest page_id is; the others are ``revisit`` records, which hold the header
alone and name the response.

Only digests and ids are grouped; the smallest ids of repeated payloads are a
written table, so that the join of a payload with thousands of copies may be
split. Payloads are shuffled at most once.

Defined results: a null html is an empty payload; a null url leaves out the
target; a null page_id is a record without number, a revisit if a numbered page
has the payload, else a response; rows that repeat the smallest page_id are all
responses; an empty table gives no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import seekable
from tidemark.llm.common import batches, materialize, open_uri, partition_id, rows_of, scratch_path, text_or_empty, write_atomically

SMALLEST_REVISIT = 100
FRAME_BYTES = 256 * 1024
RECORD = "<BqIII"  # has number, page_id, frame, offset, length
DATE = "1970-01-01T00:00:00Z"
CONTROL = re.compile("[\x00-\x20\x7f]")

BUNDLES = "number int, uri string, n_records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def urn(page_id: int | None) -> str:
    return "<urn:x-page:none>" if page_id is None else f"<urn:x-page:{page_id}>"


def number(name: str | None) -> int | None:
    return None if name is None or name.endswith(":none>") else int(name.rpartition(":")[2][:-1])


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC record; ``first``: the page whose payload it repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if first is not None:
        head += [f"WARC-Refers-To: {urn(first)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(lines: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines.decode().split("\r\n")[1:])


def parse(data: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload
    (None for a revisit); a wrong length or digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"length of record {warc['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest, kind = int(fields(http)["Content-Length"]), warc["WARC-Payload-Digest"].removeprefix("sha256:"), warc["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of record {warc['WARC-Record-ID']}")
    return number(warc["WARC-Record-ID"]), warc.get("WARC-Target-URI"), size, digest, kind, number(warc.get("WARC-Refers-To")), payload if kind == "response" else None


def write_bundles(pages: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) under ``folder``; returns the written
    table of bundles (number, uri, n_records)."""
    html = text_or_empty("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("long_enough", F.octet_length("payload") >= SMALLEST_REVISIT)
    same = rows.where("long_enough").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = materialize(same.select(F.col("digest").alias("join_key"), "first"), "warc-firsts")
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))  # short payloads match nothing, spread out
    joined = rows.withColumn("join_key", F.when(F.col("long_enough"), F.col("digest")).otherwise(own)).join(firsts, "join_key", "left")
    repeats = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    records = joined.select("page_id", "url", "payload", "digest", repeats.alias("first")).sortWithinPartitions("page_id", "digest")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next((b for b in parts if b.num_rows), None)
        if head is None:
            return
        task, count = partition_id(), 0

        def body(out) -> None:
            nonlocal count
            file, index, held = seekable.Writer(out, level), bytearray(), bytearray()
            frame = 0
            for batch in (b for source in ([head], parts) for b in source):
                for row in rows_of(batch):
                    data = record(*row)
                    index.extend(struct.pack(RECORD, row[0] is not None, row[0] or 0, frame, len(held), len(data)))
                    held.extend(data)
                    count += 1
                    if len(held) >= FRAME_BYTES:
                        frame = file.frame(bytes(held)) + 1
                        held.clear()
            if held:
                file.frame(bytes(held))
            file.close(bytes(index))

        uri = f"{folder}/pages-{task:06d}.warc.zst"
        write_atomically(uri, body)
        yield from batches([(task, uri, count)], pa.schema([("number", pa.int32()), ("uri", pa.string()), ("n_records", pa.int64())]))

    records.mapInArrow(write, BUNDLES).write.parquet(f"{folder}/bundles")
    return pages.sparkSession.read.schema(BUNDLES).parquet(f"{folder}/bundles")


def read_bundles(bundles: DataFrame, wanted: list[int] | None = None, with_payload: bool = True) -> DataFrame:
    """The records of the bundles; ``wanted``: only these pages, of which no other
    frames are read."""
    some = None if wanted is None else frozenset(wanted)

    def rows(uris: Iterator[str]) -> Iterator[tuple]:
        for uri in uris:
            with open_uri(uri) as handle:
                frames, index = seekable.read_tables(handle)
                now, data = -1, b""
                for has_number, page_id, frame, offset, length in struct.iter_unpack(RECORD, index):
                    if some is not None and (not has_number or page_id not in some):
                        continue
                    if frame != now:
                        now, data = frame, seekable.read_frame(handle, frames[frame])
                    *most, payload = parse(data[offset : offset + length])
                    yield *most, payload if with_payload else None

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        yield from batches(rows(u for b in parts for u in b.column(0).to_pylist()), schema, 512 if with_payload else 4096)

    out = bundles.select("uri").repartition(max(1, bundles.count())).mapInArrow(read, RECORDS)
    return out if with_payload else out.drop("payload")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = write_bundles(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "warc"))
    return read_bundles(bundles, with_payload=False).drop("url")


OP5_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND payload_bytes >= 100
"""
