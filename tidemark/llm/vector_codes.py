"""Vector code compression: product codes by ball k-means, exactly.

Vectors are cut into equal parts; each part has a codebook of its own. An entry and the
parts assigned to it form a ball around the entry, and ball k-means finds each part's
nearest entry without comparing it with all:

* the ball's radius defines the *neighbour entries*: only an entry no farther than twice
  the radius can be nearer to some part of the ball;
* parts nearer to their entry than half the way to the closest neighbour are the
  *stable core* and skip all work;
* the others lie in *annular rings* between half the distances to the first, second, ...
  neighbour; a part of ring r is compared with the r closest neighbours alone.

All distances are squares of integers, so this equals the full comparison, ties to the
lower index included. The radius is taken over the ball's members of one Arrow batch,
which can only shrink it. Any entry may be the ball that a part starts in: at first all
start in entry 0's, later in that of the last round.

Spark assigns the vectors where they lie and writes them with their codes, so a round
starts from the written balls of the last; counts and sums of each entry are summed by
task first, and only whole codebooks (parts x entries x width numbers) reach the driver.

Defined results: rows left out are those of ``vectors.integer_vectors``; an empty table
gives no rows; the first codebook is that of the smallest vec_ids, of equal ids that with
the smaller vector, rows without an id last, and has as many entries as there are rows
if these are fewer; repeated rows are coded one by one; a null vec_id or label stays null,
null labels count as equal; other columns are ignored; vectors of any length are taken
whole, lengths that cannot be cut into equal parts are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.vectors import integer_vectors, matrix

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
BLOCK = 8192
#: Components up to which squares of distances, four times over, fit a long.
SMALL = 2**27


def squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def nearest(x: np.ndarray, start: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, ties to the lower one, and its squared distance.
    ``start``: the entry whose ball each row is in."""
    between = squares(entries[:, None] - entries[None])
    near = np.argsort(between, axis=1, kind="stable")
    near = np.stack([row[row != i] for i, row in enumerate(near)]) if len(entries) > 1 else np.zeros((1, 0), dtype=np.int64)
    best, code = squares(x - entries[start]), start.astype(np.int64)
    ring = np.zeros(len(x), dtype=np.int64)
    by_ball = np.argsort(start, kind="stable")
    ends = np.searchsorted(start[by_ball], np.arange(len(entries) + 1))
    for ball in range(len(entries)):
        members = by_ball[ends[ball] : ends[ball + 1]]
        if len(members):
            half = between[ball][near[ball]]
            neighbours = half[: np.searchsorted(half, 4 * best[members].max(), side="right")]
            ring[members] = np.searchsorted(neighbours, 4 * best[members], side="right")
    outside = np.flatnonzero(ring)  # the others are in a stable core
    for r in range(int(ring.max(initial=0))):
        outside = outside[ring[outside] > r]
        other = near[start[outside], r]
        distance = squares(x[outside] - entries[other])
        better = (distance < best[outside]) | ((distance == best[outside]) & (other < code[outside]))
        best[outside[better]], code[outside[better]] = distance[better], other[better]
    return code, best


def exact(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as longs if their squares fit, else as integers of any size."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) < SMALL / max(1, x.shape[-1]):
        return x, entries
    return x.astype(object), entries.astype(object)


def assigned(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, x, codes (one byte a part), error of each row; ``codebooks``:
    parts x entries x width."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                x = matrix(some.column(2))
                start = np.frombuffer(b"".join(some.column(3).to_pylist()), dtype=np.uint8).reshape(len(x), -1)
                x, books = exact(x.reshape(len(x), *shared.value.shape[::2]), shared.value)
                found = [nearest(x[:, p], start[:, p], books[p]) for p in range(len(books))]
                codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                error = sum(d for _, d in found)
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.int64())], ["vec_id", "label", "x", "codes", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "x", "codes").mapInArrow(run, f"vec_id long, label {kind}, x array<long>, codes binary, error long")


def updated(coded: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Entries moved to floor(sum / count) of their parts; unused ones stay."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros(codebooks.shape, dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0))
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(len(x), parts)
            some = np.zeros(codebooks.shape, dtype=object if float(np.abs(x).max()) * len(x) >= 2**62 else np.int64)
            x = x.reshape(len(x), parts, width).astype(some.dtype)
            for p in range(parts):
                np.add.at(some[p], codes[:, p], x[:, p])
                count[p] += np.bincount(codes[:, p], minlength=entries)
            total += some
        p, e, w = (a.ravel() for a in np.indices(codebooks.shape))
        used = np.repeat(count.ravel(), width) > 0
        columns = [pa.array(a[used], pa.int32()) for a in (p, e, w)]
        columns += [pa.array(np.repeat(count.ravel(), width)[used], pa.int64()), pa.array([str(v) for v in total.ravel()[used]], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "at", "n", "total"])

    sums = coded.select("x", "codes").mapInArrow(run, "part int, entry int, at int, n long, total string").groupBy("part", "entry", "at")
    out = codebooks.copy()
    for r in sums.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():  # codebooks
        out[r.part, r.entry, r.at] = int(r.total) // r.n
    return out


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """parts x entries x width; None for an empty table."""
    found = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not found:
        return None
    x = np.array([r.x for r in found], dtype=np.int64)
    if x.shape[1] % parts:
        raise ValueError(f"vectors of {x.shape[1]} components cannot be cut into {parts} equal parts")
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of rows (vec_id, label, x) and the codebooks that they refer to."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte")
    codebooks = first_codebooks(rows, parts, entries)
    coded = rows.withColumn("codes", F.unhex(F.lit("00" * parts)))
    if codebooks is None:
        return coded.withColumn("error", F.lit(0).cast("long")), np.zeros((parts, 0, 0), dtype=np.int64)
    for _ in range(rounds):
        coded = materialize(assigned(coded, codebooks).drop("error"), "codes-round")
        codebooks = updated(coded, codebooks)
    return materialize(assigned(coded, codebooks).drop("x"), "codes-final"), codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = materialize(integer_vectors(embeddings, SCALE, others=("label",)), "codes-rows")
    coded, codebooks = compress(rows)
    by_label = materialize(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")), "codes-labels")
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("same")))  # written tables: a hot label is split
    return out.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def _assign(number: int) -> str:
    """Nearest entry (distance * 64 + entry is least) of every part under codebook ``number``."""
    return f"""a{number} AS (
  SELECT id, part, any_value(p.s) AS s, min(CAST(list_sum(list_transform(range(1, len(p.s) + 1), lambda i: (p.s[i] - c.s[i]) * (p.s[i] - c.s[i]))) AS BIGINT) * 64 + c.entry) AS k
  FROM p JOIN c{number} c USING (part) GROUP BY id, part
)"""


def _update(number: int) -> str:
    return f"""m{number} AS (
  SELECT part, entry, list(v ORDER BY i) AS s FROM (
    SELECT part, k % 64 AS entry, i, CAST(floor(CAST(sum(s[i]) AS DOUBLE) / count(*)) AS BIGINT) AS v
    FROM (SELECT part, k, s, unnest(range(1, len(s) + 1)) AS i FROM a{number}) GROUP BY ALL
  ) GROUP BY part, entry
), c{number + 1} AS (
  SELECT part, entry, coalesce(m.s, c.s) AS s FROM c{number} c LEFT JOIN m{number} m USING (part, entry)
)"""


OP13_SQL = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT id, part, e[part * len(e) // 16 + 1 : (part + 1) * len(e) // 16] AS s FROM (SELECT id, e, unnest(range(16)) AS part FROM v)
), c0 AS (
  SELECT part, id - 1 AS entry, s FROM p WHERE id <= 64
), {_assign(0)}, {_update(0)}, {_assign(1)}, {_update(1)}, {_assign(2)}, coded AS (
  SELECT id, string_agg(printf('%02x', CAST(k % 64 AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(k // 64) AS BIGINT) AS error FROM a2 GROUP BY id
), sha AS (
  SELECT sha256(string_agg(CAST(n AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(s) AS n, unnest(range(len(s))) AS i FROM c2)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN v USING (id), sha
"""
