"""Text quality by nearest-neighbour voting in a latent-semantic space.

Terms of a document are its words and word pairs, hashed to ``BUCKETS`` places each
and weighted by document frequencies that Spark counts over all documents. To them
come the trigrams of its character classes (letters, capitals, digits, kinds of
punctuation and white space) and the repetitions of its words and lines. Weights go
with square roots of shares and either kind has its fixed part of the length, so a
text's length does not matter. A truncated singular value decomposition of at most
``SAMPLE`` labelled documents (by random projection and power iteration, rows kept
sparse) gives the latent space. Their vectors, at most ``SAMPLE * DIMENSIONS`` numbers,
are broadcast; every document's cosine with all of them is computed exactly, in
blocks, and its ``NEIGHBOURS`` nearest vote with the weight of their similarity.

The sample is the labelled rows with the smallest hash, as many of either class
as there are up to half of the bound, and a vote counts by how many labelled rows
it stands for, so the score keeps to the classes' true shares.

Defined results: a null or empty text has a term of its own and is scored like any
other; a null doc_id is not held out and not learnt from; labels of unknown
documents and null labels are not learnt; repeated rows are scored one by one; of
repeated labels any one counts; with no labels at all the score is 1; of equally near
neighbours all vote, so the order of rows does not matter; very long texts are read
whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import batches, rows_of, text_or_empty

SAMPLE = 4000
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 4
BLOCK = 512
THRESHOLD = 0.7
LAGS = 8
BUCKETS = 1 << 13
LEXICAL = 0.5  # the words' part of a vector's squared length
SPARE, POWERS = 16, 4
CACHED_WORDS = 200_000
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

#: Character classes by byte: bytes of no other class, UTF-8's beyond ASCII among them, are letters.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",;:", b"!", b"?", b"|", b"'\"()[]{}", b"&%$#*@=+~^`<>\\_/-", b"\t\r\x0b\x0c\x00\x01\x02\x03\x7f"]
N_CLASSES = len(CLASSES) + 1
TABLE = np.zeros(256, dtype=np.int64)
for _number, _bytes in enumerate(CLASSES, 1):
    TABLE[list(_bytes)] = _number
TRIGRAMS = N_CLASSES**3
N_TERMS = TRIGRAMS + LAGS + 2
N_ALL = N_TERMS + 2 * BUCKETS

Row = tuple[np.ndarray, np.ndarray]  # numbers of terms, ascending, and their weights


class WordHashes(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


class Model(NamedTuple):
    axes: np.ndarray  # N_ALL x d
    vectors: np.ndarray  # rows x d, of length 1
    labels: np.ndarray
    weights: np.ndarray  # labelled rows that each vector stands for
    rarity: np.ndarray  # weights of the words' and word pairs' buckets


def terms(text: bytes) -> np.ndarray:
    """Weights of a UTF-8 text's classes and repetitions, a vector of length 1."""
    out = np.zeros(N_TERMS, dtype=np.float32)
    kinds = TABLE[np.frombuffer(b"\n" + text + b"\n", dtype=np.uint8)]
    if len(kinds) > 2:
        grams = (kinds[:-2] * N_CLASSES + kinds[1:-1]) * N_CLASSES + kinds[2:]
        out[:TRIGRAMS] = np.sqrt(np.bincount(grams, minlength=TRIGRAMS) / len(grams))
    else:
        out[-1] = 1  # empty
    words = text.lower().split()
    if len(words) > 1:
        h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
        for lag in range(1, min(LAGS, len(words) - 1) + 1):
            out[TRIGRAMS + lag - 1] = np.sqrt(np.count_nonzero(h[lag:] == h[:-lag]) / (len(h) - lag))
        lines = text.split(b"\n")
        out[TRIGRAMS + LAGS] = np.sqrt(1 - len(set(lines)) / len(lines))
    return out / np.sqrt((out**2).sum())


def buckets(text: bytes) -> Row:
    """Buckets of a UTF-8 text's words and word pairs, and how often each occurs."""
    lookup = _hashes
    h = np.array([lookup[w] for w in WORD.findall(text.lower())], dtype=np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    pairs = (pairs ^ (pairs >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    at = np.concatenate([h % np.uint64(BUCKETS), (pairs >> np.uint64(40)) % np.uint64(BUCKETS) + np.uint64(BUCKETS)])
    return np.unique(at.astype(np.int64), return_counts=True)


def row(text: bytes, rarity: np.ndarray) -> Row:
    """All terms of a text."""
    shape = terms(text)
    used = np.flatnonzero(shape)
    at, counts = buckets(text)
    weights = np.sqrt(counts) * rarity[at]
    weights *= np.sqrt(LEXICAL) / max(np.sqrt((weights**2).sum()), 1e-9)
    return np.concatenate([used, at + N_TERMS]), np.concatenate([shape[used] * np.sqrt(1 - LEXICAL), weights]).astype(np.float32)


def document_weights(docs: DataFrame) -> np.ndarray:
    """log of the inverse share of documents that hold each bucket, over all documents;
    two rows a bucket at most reach the driver."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(2 * BUCKETS + 1, dtype=np.int64)
        for batch in parts:
            for (text,) in rows_of(batch):
                held[buckets(text)[0]] += 1
                held[-1] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["bucket", "n"])

    texts = docs.select(text_or_empty().cast("binary").alias("text"))
    held = np.zeros(2 * BUCKETS + 1)
    for bucket, n in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        held[bucket] = n
    return np.log((1 + held[-1]) / (1 + held[:-1])) + 0.1


def project(rows: list[Row], axes: np.ndarray) -> np.ndarray:
    return np.stack([weights @ axes[at] for at, weights in rows])


def unproject(rows: list[Row], values: np.ndarray) -> np.ndarray:
    out = np.zeros((N_ALL, values.shape[1]), np.float32)
    for (at, weights), value in zip(rows, values, strict=True):
        out[at] += np.outer(weights, value)
    return out


def fit(rows: list[Row], labels: np.ndarray, shares: dict[int, float], rarity: np.ndarray) -> Model:
    """Latent space and sample vectors; ``shares``: labelled rows of each class."""
    if not len(rows):
        return Model(np.zeros((N_ALL, 1), np.float32), np.zeros((0, 1), np.float32), labels, np.zeros(0), rarity)
    size = min(DIMENSIONS + SPARE, len(rows))
    axes = np.random.default_rng(0).standard_normal((N_ALL, size), dtype=np.float32)
    for _ in range(POWERS):
        left = np.linalg.qr(project(rows, axes))[0]
        axes = np.linalg.qr(unproject(rows, left))[0]
    left = np.linalg.qr(project(rows, axes))[0]
    axes, values, _ = np.linalg.svd(unproject(rows, left), full_matrices=False)
    axes = np.ascontiguousarray(axes[:, :DIMENSIONS][:, values[:DIMENSIONS] > 1e-4 * values[0]])
    weights = np.array([shares[int(y)] / np.count_nonzero(labels == y) for y in labels])
    return Model(axes, unit(project(rows, axes)), labels.astype(np.float64), weights / weights.max(), rarity)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-9)


def scores(rows: list[Row], model: Model) -> np.ndarray:
    """Share of label 1 among the nearest neighbours' weighted votes; all that tie with the
    last neighbour vote."""
    if not len(model.vectors):
        return np.ones(len(rows))
    cosine = unit(project(rows, model.axes)) @ model.vectors.T
    k = min(NEIGHBOURS, cosine.shape[1])
    cosine = np.round(cosine, 5)  # equal vectors tie, whatever the product's last bits
    row, near = np.nonzero(cosine >= np.partition(cosine, -k, axis=1)[:, [-k]])
    votes = np.maximum(cosine[row, near], 1e-6).astype(np.float64) ** SHARPNESS * model.weights[near]
    return np.bincount(row, votes * model.labels[near], len(rows)) / np.bincount(row, votes, len(rows))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled, not held-out rows."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    shares = {int(r[0]): float(r[1]) for r in known.groupBy("quality").count().collect()}  # two rows
    half = sample // 2
    chosen = [known.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample - half if len(shares) > 1 else sample) for y in shares]
    if not chosen:
        return fit([], np.zeros(0), {}, np.zeros(2 * BUCKETS))
    few = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))

    rarity = document_weights(docs)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = ((i, y, *row(t, rarity)) for b in parts for i, y, t in rows_of(b))
        rows = ((i, y, at.astype(np.int32).tobytes(), weights.tobytes()) for i, y, at, weights in some)
        yield from batches(rows, pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("terms", pa.binary()), ("weights", pa.binary())]), 256)

    found = texts.join(F.broadcast(few), "doc_id").select("doc_id", "quality", "text")  # few: at most sample rows
    rows = found.mapInArrow(run, "doc_id long, quality int, terms binary, weights binary").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    sparse = [(np.frombuffer(r.terms, dtype=np.int32), np.frombuffer(r.weights, dtype=np.float32)) for r in rows]
    return fit(sparse, np.array([r.quality for r in rows]), shares, rarity)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score of ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    text = "__text"
    while text in names:
        text += "_"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                values = scores([row(t.as_py(), known.rarity) if len(known.vectors) else () for t in some.column(some.num_columns - 1)], known)
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(values, pa.float64())], [*names, column])

    kept = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.withColumn(text, text_or_empty().cast("binary")).mapInArrow(run, kept)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(narrow, model).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
