"""Scalar column expressions of the silver and gold models.

All are built-in Catalyst expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import (
    BUCKET_MEDIUM_MAX,
    BUCKET_SMALL_MAX,
    BUSINESS_AREA,
    SOURCE_SYSTEM,
    ZONE_AREA,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lineage_constants(dataset: str) -> list[Column]:
    """Four lineage literals written into every silver row."""
    return [
        F.lit(ZONE_AREA).alias("zone_area"),
        F.lit(BUSINESS_AREA).alias("business_area"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(dataset).alias("dataset"),
    ]


def null_to_zero(c: str | Column) -> Column:
    """Missing reference key -> 0 (it then matches no one in inner joins)."""
    return F.coalesce(_c(c), F.lit(0).cast("bigint"))


def blank_to_null(c: str | Column) -> Column:
    """Exactly '' -> null; whitespace is kept as is."""
    return F.nullif(_c(c), F.lit(""))


def sale_bucket(amount: str | Column) -> Column:
    """Sale-size bucket of one line amount: Small / Medium / Big.

    The bounds are inclusive on the lower bucket; a null amount is Big.
    """
    a = _c(amount)
    return (
        F.when(a <= BUCKET_SMALL_MAX, "Small")
        .when(a.between(BUCKET_SMALL_MAX, BUCKET_MEDIUM_MAX), "Medium")
        .otherwise("Big")
    )


def line_amount(quantity: str | Column, price: str | Column) -> Column:
    """quantity * price computed exactly in decimal, stored as double."""
    return (_c(quantity) * _c(price)).cast("double")
