"""Change-feed operators: operation filter, conform, latest image per key.

``latest_per_key`` is ``row_number() ... = 1``; Spark plans it as a partial
``WindowGroupLimit`` before the shuffle (each map task keeps one row per key)
and a final one after it, so a key holding a third of all change rows sends
one row per map task over the network, not a third of the feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import OP_RANK, TableSpec
from tidemark.functions.scalar import lineage_constants
from tidemark.functions.time import parse_extract_at, shift_local


def cdc_filter(df: DataFrame, ops: Sequence[str]) -> DataFrame:
    """Keep the listed change operations; pushed to the Parquet scan."""
    return df.where(F.col("op").isin(*ops))


def op_rank(c: str | Column = "op") -> Column:
    """D > U > I when two images of a key carry the same change time."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for op, rank in OP_RANK.items():
        expr = (F.when(col == op, rank) if expr is None else expr.when(col == op, rank))
    return expr.otherwise(-1)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Bronze row -> silver columns, keeping the ordering helpers.

    Adds ``_ts`` (parsed UTC change time) and ``_op`` (operation rank); the
    silver ``extract_at`` is ``_ts`` shifted to UTC-3 unless the spec stores
    change times as landed. One projection (the parse is shared by both uses).
    """
    ts = parse_extract_at("extract_at")
    stored = shift_local(ts) if spec.shift_ts else ts
    return df.select(
        *[F.expr(e).alias(n) for n, e in spec.columns],
        *lineage_constants(spec.name),
        stored.alias("extract_at"),
        ts.alias("_ts"),
        op_rank("op").alias("_op"),
    )


def latest_order(ts: str, tiebreak: Sequence[str], op_col: str | None = "_op") -> list[Column]:
    """Total order, newest first: change time, operation, then payload."""
    cols = [F.col(ts).desc_nulls_last()]
    if op_col:
        cols.append(F.col(op_col).desc_nulls_last())
    cols += [F.col(c).desc_nulls_last() for c in tiebreak]
    return cols


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "_ts",
    tiebreak: Sequence[str] = (),
    op_col: str | None = "_op",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the newest image under a total, deterministic order.

    ``keep`` selects the output columns (default: all input columns).
    """
    w = Window.partitionBy(*keys).orderBy(*latest_order(ts, tiebreak, op_col))
    out = list(keep) if keep is not None else df.columns
    return df.select("*", F.row_number().over(w).alias("_rn")).where(F.col("_rn") == 1).select(*out)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop("_ts", "_op")
