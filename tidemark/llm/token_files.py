"""Token-ID files: one Zstandard frame per document, a document index and a
trailing seek table with per-frame checksums.

Files have the layout of :mod:`tidemark.llm.seekable`; frame i holds the ids of
document i as little-endian uint32, and the index holds, for every document, a
byte that says whether it has an id, and the id as i64. A reader of one document
fetches the tables from the end of the file and decompresses that frame only.

Rows are range-partitioned by ``doc_id`` and sorted, one file per partition, so
files in number order hold the ids in ascending ``doc_id`` order.

Defined results: a null or empty text has the end id only; a null ``doc_id``
sorts first and stays null; repeated ``doc_id`` rows are all written, ordered by
text; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import seekable, tokens
from tidemark.llm.common import batches, open_uri, partition_id, rows_of, scratch_path, text_or_empty, write_atomically

DOCUMENT = "<Bq"

FILES = "number int, uri string, n_docs long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = tokens.VOCABULARY, end_id: int = tokens.END_ID, level: int = 1) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files under ``folder``; returns the table
    of files (number, uri, n_docs, n_tokens, first_token), itself stored there."""

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids_of = partition_id(), tokens.encoder(vocabulary)
        end = tokens.as_bytes([end_id])
        first = next((b for b in parts if b.num_rows), None)
        if first is None:
            return
        index, docs, total = bytearray(), 0, 0

        def body(out) -> None:
            nonlocal docs, total
            file = seekable.Writer(out, level)
            for batch in (b for source in ([first], parts) for b in source):
                for doc_id, text in rows_of(batch):
                    ids = tokens.encode(text, ids_of) + end
                    file.frame(ids)
                    index.extend(struct.pack(DOCUMENT, doc_id is not None, doc_id or 0))
                    docs, total = docs + 1, total + len(ids) // 4
            file.close(bytes(index))

        uri = f"{folder}/ids-{number:06d}.zst"
        write_atomically(uri, body)
        yield from batches([(number, uri, docs, total)], pa.schema([("number", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, FILES).write.parquet(f"{folder}/files")
    files = spark.read.schema(FILES).parquet(f"{folder}/files")  # one row per file
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, wanted: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), n_tokens,
    ids_crc32 and, with ``with_ids``, the ids. ``wanted``: only these documents,
    whose frames alone are read and decompressed."""
    some = None if wanted is None else frozenset(wanted)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in parts:
                for uri, first in rows_of(batch):
                    with open_uri(uri) as handle:
                        start = first
                        frames, index = seekable.read_tables(handle)
                        for frame, (has_id, number) in zip(frames, struct.iter_unpack(DOCUMENT, index), strict=True):
                            n, doc_id = frame.full // 4, number if has_id else None
                            if some is None or doc_id in some:
                                ids = seekable.read_frame(handle, frame)
                                yield doc_id, start, n, zlib.crc32(ids), ids if with_ids else None
                            start += n

        yield from batches(rows(), pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]), 512 if with_ids else 8192)

    n_files = max(1, files.count())
    out = files.select("uri", "first_token").repartition(n_files).mapInArrow(read, DOCS)
    return out if with_ids else out.drop("ids")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = write_token_files(docs, scratch_path(spark, "token-files"))
    return read_token_files(files, with_ids=False)
