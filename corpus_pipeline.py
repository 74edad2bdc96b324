"""The corpus pipeline: quality, near-duplicates, benchmark leaks, packing.

Every stage takes what its predecessor kept; all but the last return the columns
that they were given. A row is judged by its own text: rows are told apart by
their doc_id, null or not, and a 64-bit hash of the text, so another row under the
same doc_id decides nothing about it.

Defined results, for every stage: null texts count as empty; an empty table gives
no rows; other columns stay as they are, whatever their names; very long texts are
read whole; empty ``labels`` (every score is 1) and an empty ``benchmark`` drop
nothing. What else each stage defines stands in its own docstring.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import leaks, near_dup, packing, quality
from tidemark.llm.common import bound_batches, materialize

#: Columns that the stages add for a while; no input column has such a name.
SCORE, ID, KEY = "__pipeline_score", "__pipeline_doc_id", "__pipeline_row_key"
#: Similarity of five-word shingles from which on the pipeline drops a copy (the query op2 has 85).
COPY_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that score under the threshold go. Repeated rows and rows
    without a doc_id are scored like any other; ties at the threshold stay."""
    bound_batches(spark)
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, SCORE).where(F.col(SCORE) >= quality.THRESHOLD).drop(SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one row of each group of near-duplicates stays, that with the smallest
    doc_id (rows without one come last; of equal ids the smallest hash of the text).
    Of rows that repeat doc_id and text one stays, whichever; texts without words are
    copies of nothing else."""
    bound_batches(spark)
    rows = materialize(near_dup.judged(docs, COPY_PERCENT, nameless=True), "pipeline-judged")
    first = F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.row_key") == F.col("row_key"))
    gone = rows.where(F.col("best").isNotNull() & ~first).select("doc_id", "row_key").distinct()
    again = rows.groupBy("doc_id", "row_key").count().where("count > 1").select("doc_id", "row_key")
    kept = joined(docs, gone, "left_anti")
    repeated = materialize(again, "pipeline-repeated")
    if repeated.isEmpty():
        return kept
    once = joined(kept, repeated, "left_semi").withColumn(KEY, near_dup.row_key()).dropDuplicates(["doc_id", KEY]).drop(KEY)
    return joined(kept, repeated, "left_anti").unionByName(once)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark item go. A text is judged by itself,
    under the hash of it, so rows without a doc_id and rows that repeat one are judged too;
    all rows with a text that leaks go."""
    bound_batches(spark)
    texts = docs.select(near_dup.row_key().alias("doc_id"), "text")
    found = leaks.leaks(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = materialize(found.select(F.col("doc_id").alias(KEY)).distinct(), "pipeline-gone")
    far, near = parted(docs, gone)
    return far.union(near.join(gone, near_dup.row_key() == gone[KEY], "left_anti"))


def joined(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` semi or anti joined with rows (doc_id, row_key), null-safe."""
    rows = materialize(rows.select(F.col("doc_id").alias(ID), F.col("row_key").alias(KEY)), "pipeline-rows")
    far, near = parted(docs, rows)
    found = near.join(rows, same_row(near, rows), how)
    return found if how == "left_semi" else far.union(found)


def parted(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose text has no hash of ``rows``, and all others. A Bloom
    filter of fixed size parts them where they lie, so a join with ``rows`` shuffles the
    others alone, not every whole text."""
    bits = leaks.bloom(rows.select(F.col(KEY).alias("gram")))
    may = F.pandas_udf(lambda keys: pd.Series(leaks.passes(bits, keys.to_numpy(dtype=np.int64))), "boolean")(near_dup.row_key())
    return docs.where(~may), docs.where(may)


def same_row(docs: DataFrame, rows: DataFrame) -> Column:
    return docs["doc_id"].eqNullSafe(rows[ID]) & (near_dup.row_key() == rows[KEY])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: what is left, as pieces of sequences with their token ids; rows that
    repeat a doc_id, or have none, are packed one by one."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_sequences),
]
#: Scores, alignments and token ids cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on its predecessor's written rows
    (whole texts, three times: zstd, for the disk)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"), "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
