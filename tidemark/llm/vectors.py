"""Rows of ``embeddings`` as integer vectors: what the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components beyond this are an error: a long and its sums must hold them.
LARGEST = 1e17


def integer_vectors(embeddings: DataFrame, scale: int, offset: int = 0, others: tuple[str, ...] = ()) -> DataFrame:
    """vec_id, ``others`` and x = floor(scale * component) + offset as array<long>.

    Left out are vectors that are null, empty or hold null or non-finite components,
    and those of another length than the vector with the smallest vec_id (rows without
    an id come last, of equal ids the longest counts)."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), *others, vector.alias("e"))
    rows = rows.where("e is not null and size(e) > 0 and forall(e, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    length = rows.agg(F.min_by(F.size("e"), F.struct(F.col("vec_id").isNull(), "vec_id", -F.size("e"))).alias("n")).first().n
    whole = f"if(abs(double({scale}) * c) < {LARGEST}D, floor(double({scale}) * c) + {offset}L, raise_error('component too large'))"
    return rows.where(F.size("e") == F.lit(length or 0)).select("vec_id", *others, F.expr(f"transform(e, c -> {whole})").alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """A list column of equal lengths as rows of int64."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)
