"""Upsert (MERGE: matched -> replace, not matched -> insert) on plain Parquet.

``upsert`` is ``target LEFT ANTI source.keys UNION ALL source``: two
distributed plans joined on the merge key, no driver work. Null keys never
match, as in MERGE. ``newer_only`` adds the guard a replayed micro-batch
needs: the newest image wins even if an older batch is applied again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cdc import latest_per_key


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (distributed, partial aggregation)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a merge key is ambiguous. One action; reads only the keys and shuffles
    hashes of them. Keys are compared only if a hash repeats."""
    hashes = df.select(F.xxhash64(*keys).alias("_key"))
    if duplicate_keys(hashes, ["_key"]).isEmpty():
        return
    dup = duplicate_keys(df.select(*keys), keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"merge key {list(keys)} not unique, e.g. {dup[0].asDict()}")


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    newer_only: Sequence[str] | None = None,
    check_unique: bool = False,
) -> DataFrame:
    """Replace target rows whose key is in ``source``, insert the others.

    newer_only  ordering columns (newest first, e.g. ``["extract_at"]``); when
                given, a source row replaces a target row only if it is newer.
    """
    if check_unique:
        assert_unique_keys(source, keys)
    if target is None:
        return source
    cols = target.columns
    source = source.select(*cols)
    if newer_only:
        skeys = source.select(*keys)
        kept = target.join(skeys, list(keys), "left_anti").select(*cols)
        # Only keys present in the source can change: their old and new images
        # compete, the newest wins (a replayed older batch changes nothing).
        contenders = (
            target.join(skeys.distinct(), list(keys), "left_semi").withColumn("_side", F.lit(0))
            .unionByName(source.withColumn("_side", F.lit(1)))
        )
        winners = latest_per_key(contenders, keys, ts=newer_only[0],
                                 tiebreak=list(newer_only[1:]) + ["_side"], op_col=None)
        return kept.unionByName(winners.select(*cols))
    # (a USING join puts the keys first: restore the table's column order)
    untouched = target.join(source.select(*keys), list(keys), "left_anti").select(*cols)
    return untouched.unionByName(source)


def newer_source(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The source rows that beat the target's image of their key under ``order``
    (newest first, nulls last); on a full tie the source wins. Source keys are unique.
    Reads only keys and order of the target; one join."""
    s, t = source.alias("s"), target.select(*keys, *(c for c in order if c not in keys)).alias("t")
    # Structs compare field by field, nulls below all values, as the order does.
    beaten = F.struct(*(F.col(f"t.{c}") for c in order)) > F.struct(*(F.col(f"s.{c}") for c in order))
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    return s.join(t, [*same, beaten], "left_anti").select(*source.columns)


def upsert_partitions(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                      partition_col: str, movable: bool = True, places: set | None = None) -> tuple[DataFrame, list]:
    """Merged content of the partitions that a merge touches, and those of them that
    it may leave without rows (see ``StoredTable.replace_partitions``).

    Touched are the partitions of the source rows and, where a key may move to
    another partition (``movable``), those where the target holds a key of the
    source: ``places``, if a key locator knows them (too many do no harm), else the
    target's key columns are read for them. They become a literal ``IN`` filter, so only they are read in full; the list is never longer than the
    table's partition listing. ``source`` is read several times: pass a written
    table.
    """
    if target is None:
        return source, []
    p = partition_col
    skeys = source.select(*keys)
    new = {r[0] for r in source.select(p).distinct().collect()}
    old = set()
    if movable and places is not None:
        old = places - new
    elif movable:
        held = target.select(*keys, p)
        old = {r[0] for r in held.join(skeys, list(keys), "left_semi").select(p).distinct().collect()} - new
    affected = target.where(partition_in(p, new | old))
    return upsert(affected, source, keys), sorted(old, key=str)


def partition_in(col: str, values: set) -> Column:
    present = sorted(v for v in values if v is not None)
    cond = F.col(col).isin(present) if present else F.lit(False)
    return cond | F.col(col).isNull() if None in values else cond
