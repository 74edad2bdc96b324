"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are range-partitioned by length and packed into buckets of similar
length. The longest vectors give every query a first k-th best score. With that
score t, a bucket whose longest vector is l can only hold better ones at a cosine
of at least t / (|q| * l), its local threshold:

* above 1 the whole bucket is pruned;
* a high threshold prunes by coordinate: on the query's largest coordinates a
  vector at that cosine must lie in an interval around the query's own value;
* a low threshold prunes by length: only vectors with |q| * |p| >= t are left.

The products of what is left are computed exactly and the best k kept, ties to
the smaller id. Bounds carry a slack far above rounding, so pruning loses nothing.

Query blocks meet groups of buckets in separate tasks, so neither side is ever
whole in a task or in the driver.

Defined results: vectors that are null or hold null or non-finite components take
no part; vectors of unequal dimension are not compared; a row's own id is no
candidate of it; repeated rows of an id are candidates one by one; a null id is
neither query nor candidate; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, materialize

BUCKET_ROWS = 1024
QUERY_ROWS = 512
BUCKETS_PER_TASK = 8
COORDINATES = 4
#: From this local cosine threshold on, intervals on coordinates prune more than lengths.
COORDINATE_COSINE = 0.5
EXACT = float(2**53)

BLOCKS = "rows int, dim int, longest double, ids binary, vectors binary"
HITS = "block int, query_id long, vec_id long, score long"


def scaled(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (floor(1024 * x) as doubles, exact), length2; valid vectors only."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("e"))
    rows = rows.where("vec_id is not null and e is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = rows.select("vec_id", F.expr("transform(e, x -> double(floor(double(1024) * x)))").alias("v"))
    return rows.withColumn("length2", F.expr("aggregate(v, double(0), (s, x) -> s + x * x)"))


def pack_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Consecutive rows of equal dimension as one row: ids and matrix."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rows", pa.int32()), ("dim", pa.int32()), ("longest", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())])

        def blocks() -> Iterator[tuple]:
            held: dict[int, list[tuple[int, np.ndarray]]] = {}
            for batch in parts:
                for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    x = v.values.to_numpy(zero_copy_only=False)
                    some = held.setdefault(len(x), [])
                    some.append((vec_id, x))
                    if len(some) == size:
                        yield block(held.pop(len(x)))
            for some in held.values():
                yield block(some)

        yield from batches(blocks(), schema, 16)

    return rows.select("vec_id", "v").mapInArrow(run, BLOCKS)


def block(some: list[tuple[int, np.ndarray]]) -> tuple:
    ids, vectors = np.array([i for i, _ in some], dtype=np.int64), np.stack([x for _, x in some])
    return len(some), vectors.shape[1], float(np.sqrt((vectors**2).sum(axis=1).max())), ids.tobytes(), vectors.tobytes()


def unpack(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.vectors, dtype=np.float64).reshape(row.rows, row.dim)


def products(vectors: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products: doubles hold them below 2**53, integers of any size beyond."""
    if bound < EXACT:
        return (vectors @ query).astype(np.int64)
    q = [int(x) for x in query]
    exact = [sum(int(x) * y for x, y in zip(p, q, strict=True)) for p in vectors]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in exact], dtype=np.int64)


class Best:
    """The k best (score, vec_id) of one query so far."""

    def __init__(self, k: int, floor: float):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores.astype(object) if len(scores) and scores.min() == -(2**63) else -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, float(self.scores[-1]))


def candidates(vectors: np.ndarray, lengths: np.ndarray, unit: np.ndarray, query: np.ndarray, q_length: float, longest: float, floor: float) -> np.ndarray | slice:
    """Rows of a bucket (longest first) that may reach ``floor``."""
    if floor <= 0 or q_length == 0 or longest == 0:
        return slice(None)  # no bound: a zero or negative score may still be among the best
    local = floor / (q_length * longest) * (1 - 1e-9)
    if local > 1:
        return slice(0, 0)
    if local < COORDINATE_COSINE:
        return slice(0, int(np.searchsorted(-lengths, -floor / q_length * (1 - 1e-9), side="right")))
    direction, keep = query / q_length, np.ones(len(lengths), dtype=bool)
    for f in np.argsort(-np.abs(direction))[:COORDINATES]:
        spread = np.sqrt(max(0.0, (1 - direction[f] ** 2) * (1 - local**2))) + 1e-9
        keep &= np.abs(unit[:, f] - direction[f] * local) <= spread + abs(direction[f]) * (1 - local)
    return np.flatnonzero(keep)


def search(query_block, buckets: list, k: int, floors: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The k best of each query in these buckets, longest vectors first."""
    query_ids, queries = unpack(query_block)
    q_lengths = np.sqrt((queries**2).sum(axis=1))
    best = [Best(k, f) for f in floors]
    for bucket in sorted(buckets, key=lambda b: -b.longest):
        if bucket.dim != query_block.dim:
            continue
        ids, vectors = unpack(bucket)
        lengths = np.sqrt((vectors**2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        ids, vectors, lengths = ids[order], vectors[order], lengths[order]
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        for i, query in enumerate(queries):
            rows = candidates(vectors, lengths, unit, query, q_lengths[i], bucket.longest, best[i].floor)
            some = ids[rows]
            if len(some):
                scores = products(vectors[rows], query, q_lengths[i] * bucket.longest * 1.01)
                other = some != query_ids[i]
                good = other & (scores >= best[i].floor)
                best[i].add(scores[good], some[good])
    for query_id, b in zip(query_ids.tolist(), best, strict=True):
        for score, vec_id in zip(b.scores.tolist(), b.ids.tolist(), strict=True):
            yield query_id, vec_id, score


def top_k(embeddings: DataFrame, is_query: str, k: int = 10) -> DataFrame:
    """The k best rows of ``embeddings`` for each row that satisfies ``is_query``
    (SQL over vec_id): query_id, rank, vec_id, score."""
    vectors = scaled(embeddings)
    by_length = vectors.repartitionByRange(F.col("length2").desc(), F.col("vec_id")).sortWithinPartitions(F.col("length2").desc(), "vec_id")
    grouped = numbered(pack_blocks(by_length, BUCKET_ROWS), "topk-buckets", F.col("longest").desc())
    grouped = grouped.withColumn("task", F.floor(F.col("number") / BUCKETS_PER_TASK).cast("int"))
    spread = vectors.where(is_query).repartition("vec_id").sortWithinPartitions("vec_id")
    queries = numbered(pack_blocks(spread, QUERY_ROWS), "topk-queries", F.col("id")).withColumnRenamed("number", "block")

    first = hits(queries.withColumn("floors", F.lit(None).cast("binary")), grouped.where("task = 0"), k)
    first = materialize(first, "topk-first")
    floors = first.groupBy("block", "query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    rest = hits(with_floors(queries, floors), grouped.where("task > 0"), k)
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def numbered(blocks: DataFrame, name: str, by) -> DataFrame:
    """Written blocks with a number from 0 in the order of ``by``; only the narrow
    columns, one row per block, are put in that order."""
    written = materialize(blocks.withColumn("id", F.monotonically_increasing_id()), name)
    order = written.select("id", (F.row_number().over(Window.orderBy(by, "id")) - 1).alias("number"))
    return materialize(written.join(order, "id").drop("id"), f"{name}-numbered")


def with_floors(queries: DataFrame, floors: DataFrame) -> DataFrame:
    """Attach each query's k-th best score so far, in the block's order."""

    def run(key, some: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        by_id = dict(zip(known["query_id"], known["floor"], strict=True))
        values = [np.array([by_id.get(i, -np.inf) for i in np.frombuffer(b, dtype=np.int64)]).tobytes() for b in some["ids"]]
        return some.assign(floors=values)

    return queries.groupBy("block").cogroup(floors.groupBy("block")).applyInPandas(run, f"{BLOCKS}, block int, floors binary")


def hits(queries: DataFrame, grouped: DataFrame, k: int) -> DataFrame:
    """Every query block against every group of buckets: one task's work each."""

    def run(key, some: pd.DataFrame, buckets: pd.DataFrame) -> pd.DataFrame:
        members, out = list(buckets.itertuples()), []
        for q in some.itertuples():
            floors = np.full(q.rows, -np.inf) if q.floors is None else np.frombuffer(q.floors, dtype=np.float64)
            out += ((key[0], *hit) for hit in search(q, members, k, floors))
        return pd.DataFrame(out, columns=["block", "query_id", "vec_id", "score"]).astype("int64")

    tasks = grouped.select("task").distinct().agg(F.collect_set("task").alias("tasks"))  # one number per group
    blocks = queries.select("block").distinct().agg(F.collect_set("block").alias("blocks"))  # one per query block
    spread_q = queries.join(F.broadcast(tasks)).withColumn("task", F.explode("tasks")).drop("tasks")
    spread_b = grouped.join(F.broadcast(blocks)).withColumn("block", F.explode("blocks")).drop("blocks")
    return spread_q.groupBy("block", "task").cogroup(spread_b.groupBy("block", "task")).applyInPandas(run, HITS)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
