"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are its words, its word pairs and its skip-grams (pairs with one or
two words between them), hashed to ``BUCKETS`` places; each counts once however often it
occurs, so one insult in a long text weighs as much as in a short one. The model learns
by follow-the-regularised-leader: every coordinate has a learning rate of its own, which
falls with the gradients that it has seen, and the L1 term keeps weights at zero until
their evidence passes ``L1``. Words that any topic uses, and chance ones of a wrong
label, so stay out, and what is broadcast is the few thousand weights that are not zero.

Spark hashes the texts, counts in how many sampled texts each feature occurs and scores
all documents; the sequential learning itself runs over a bounded sample: at most
``SAMPLE`` labelled rows, those with the smallest hash, as many of either class as there
are up to half of the bound. A row's gradient is weighted by how many labelled rows it
stands for, so the scores keep to the classes' true shares. Features of fewer than
``LEAST_TEXTS`` sampled texts are left out of the learning.

Defined results: a null or empty text has no features and gets the score of the
intercept; very long texts count whole; a null doc_id is not held out and not learnt
from; labels of unknown documents and null labels are not learnt; of repeated labels any
toxic one counts; repeated rows are scored one by one; the learning order is that of a
hash of the doc_id, so equal tables give equal weights; with no labels at all the score
is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import batches, materialize, rows_of, text_or_empty
from tidemark.llm.quality import held_out

SAMPLE = 8000
LEAST_TEXTS = 3
BUCKETS = 1 << 22
BLOCK = 4096  # places that travel as one row of bits
SKIPS = (1, 2, 3)  # places from a pair's first word to its second
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.01
PASSES = 3
THRESHOLD = 0.3
CACHED_WORDS = 200_000
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


class WordHashes(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


class Model(NamedTuple):
    places: np.ndarray  # ascending buckets of the weights that are not zero
    weights: np.ndarray
    intercept: float


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(42)).astype(np.int32)


def features(text: bytes) -> np.ndarray:
    """Buckets of a UTF-8 text's words, pairs and skip-grams, with repetitions."""
    lookup = _hashes
    h = np.array([lookup[w] for w in WORD.findall(text.lower())], dtype=np.uint64)
    pairs = [(h[:-skip] * FACTORS[0]) ^ (h[skip:] + FACTORS[skip]) for skip in SKIPS]
    return np.concatenate([mixed(h), *(mixed(p) for p in pairs)])


def logistic(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -40.0), 40.0)))


def learnt(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, places: np.ndarray) -> Model:
    """FTRL-proximal over the rows in their order; each holds distinct indices into
    ``places`` (ascending buckets) and, last, that of the intercept: ``len(places)``."""
    if not len(rows):
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), -np.inf)
    z, n = np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    l1 = np.full(len(places) + 1, L1)
    l1[-1] = 0

    def weight(i: np.ndarray | slice) -> np.ndarray:
        beyond = np.maximum(np.abs(z[i]) - l1[i], 0)
        return -np.sign(z[i]) * beyond / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(PASSES):
        for i, y, share in zip(rows, labels, weights, strict=True):
            w = weight(i)
            g = (logistic(float(w.sum())) - y) * share
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weight(slice(None))
    used = np.flatnonzero(w[:-1])
    return Model(places[used], w[used].astype(np.float32), float(w[-1]))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled, not held-out rows."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known, "toxic-known")
    shares = {int(r[0]): int(r[1]) for r in known.groupBy("toxic").count().collect()}  # two rows
    if not shares:
        return learnt([], np.zeros(0), np.zeros(0), np.zeros(0, np.int32))
    few = None
    for y, count in sorted(shares.items()):
        room = sample - min(sample // 2, sum(shares.values()) - count)  # what the other class leaves
        some = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(room)
        few = some if few is None else few.unionByName(some)
    few = materialize(few, "toxic-sample")  # at most ``sample`` narrow rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = ((i, y, np.unique(features(t)).astype(np.int32).tobytes()) for b in parts for i, y, t in rows_of(b))
        yield from batches(some, pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("features", pa.binary())]), 64)

    found = texts.join(F.broadcast(few), "doc_id").select("doc_id", "toxic", "text")
    hashed = materialize(found.mapInArrow(run, "doc_id long, toxic int, features binary").dropDuplicates(["doc_id"]), "toxic-features")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, dtype=np.int32)
        for batch in parts:
            for (row,) in rows_of(batch):
                held[np.frombuffer(row, dtype=np.int32)] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at], pa.int64())], ["place", "n"])

    def as_bits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for block, places in rows_of(batch):
                held = np.zeros(BLOCK, dtype=bool)
                held[np.array(places) % BLOCK] = True
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["block", "bits"])

    often = hashed.select("features").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TEXTS)
    blocks = often.groupBy(F.expr(f"place div {BLOCK}").alias("block")).agg(F.collect_list("place").alias("places"))  # at most BLOCK each
    kept = np.zeros(BUCKETS, dtype=bool)
    for block, bits in blocks.mapInArrow(as_bits, "block long, bits binary").collect():  # one bit a place
        kept[block * BLOCK : (block + 1) * BLOCK] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).astype(bool)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(kept))

    def indexed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        index = np.cumsum(bits, dtype=np.int32) - 1
        for batch in parts:
            for i, y, row in rows_of(batch):
                row = np.frombuffer(row, dtype=np.int32)
                row = np.append(index[row[bits[row]]], index[-1] + 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([y], pa.int32()), pa.array([row.tobytes()], pa.binary())], ["doc_id", "toxic", "features"])

    rows = hashed.mapInArrow(indexed, "doc_id long, toxic int, features binary").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").collect()
    y = np.array([r.toxic for r in rows])
    stands_for = np.array([shares[t] / np.count_nonzero(y == t) for t in y])
    places = np.flatnonzero(kept).astype(np.int32)
    return learnt([np.frombuffer(r.features, dtype=np.int32) for r in rows], y, stands_for / stands_for.mean() if len(y) else stands_for, places)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with all its columns and the probability that ``text`` is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    text = "__text"
    while text in names:
        text += "_"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table = np.zeros(BUCKETS, dtype=np.float32)
        table[known.places] = known.weights

        def one(value: bytes) -> float:
            at = features(value)
            return logistic(float(table[np.unique(at[table[at] != 0])].sum(dtype=np.float64)) + known.intercept) if known.intercept > -np.inf else 0.0

        for batch in parts:
            values = [one(t) for (t,) in rows_of(batch.select([batch.num_columns - 1]))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.float64())], [*names, column])

    kept = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.withColumn(text, text_or_empty().cast("binary")).mapInArrow(run, kept)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
