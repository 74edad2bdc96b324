"""Dashboard aggregates that are kept beside the mart instead of built from it.

A ``Lakehouse(..., dashboards=True)`` stores, per mart partition (month), the sums of each
country, territory and city. Whatever replaces partitions of the mart (an increment, a
recompute, touched groups, a full refresh) replaces the sums of the same months, from those
partitions alone; the dashboards add up some sums per month and city and never scan the
mart. Sums are not added to, so there is nothing to count twice: quantities and amounts of
a month are always those of its partition, exact decimals until the last sum.

The months are logged before the mart changes and the entry goes once their sums are in
place. A run that dies in between leaves it, and the next one builds these months again. A
mart that was there before its dashboards gives its sums in one scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import partition_in
from tidemark.plans.gold import MONEY_SUM
from tidemark.plans.maintain import ChangeLog
from tidemark.sources.storage import StoredTable

if TYPE_CHECKING:
    from tidemark.plans.jobs import Lakehouse

PLACES = ["locality_country", "locality_territory", "locality_city"]


def month_sums(mart: DataFrame, month_col: str) -> DataFrame:
    """Null quantities and amounts count as in the dashboards: a sum of nulls is null."""
    return mart.groupBy(month_col, *PLACES).agg(
        F.sum("sales_quantityordered").cast("long").alias("quantity"),
        F.sum(F.col("sales_amount").cast(MONEY_SUM)).cast(MONEY_SUM).alias("amount"))


class Dashboards:
    def __init__(self, house: Lakehouse):
        self.mart = house.gold
        self.month = house.gold.partition_col
        text = T.StringType()
        self.store = StoredTable(house.spark, f"{house.root}/gold/dashboard_sums", T.StructType(
            [T.StructField(c, text) for c in PLACES] + [T.StructField("quantity", T.LongType()),
             T.StructField("amount", T.DecimalType(38, 2)), T.StructField(self.month, text)]), self.month)
        self.log = ChangeLog(house.spark, f"{house.root}/changes/mart-months", T.StructType([T.StructField(self.month, text)]))

    def announce(self, months: Iterable[str | None]) -> None:
        """Log the months of the mart that are about to be replaced or removed."""
        self.log.append(self.log.spark.createDataFrame([(m,) for m in months], self.log.schema))

    def refresh(self) -> None:
        """Build the sums of all logged months from their partitions of the mart."""
        entries, mart = self.log.entries(), self.mart.read()
        known = self.store.partitions()
        if mart is not None and not known:
            self.store.replace_partitions(month_sums(mart, self.month))
        elif entries:
            months = {r[0] for r in self.log.read(entries).distinct().collect()}  # at most the mart's partitions
            there = set(self.mart.partitions())
            if months & there:
                self.store.replace_partitions(self.of_months(months & there))
            for m in (months - there) & set(known):
                self.store.remove(m)
        self.log.clear(entries)

    def of_months(self, months: set) -> DataFrame:
        return month_sums(self.mart.read().where(partition_in(self.month, months)), self.month)

    def sums(self) -> DataFrame:
        found = self.store.read()
        return found if found is not None else self.store.spark.createDataFrame([], self.store.schema)

    def quantity_by_country(self) -> DataFrame:
        return self.sums().groupBy("locality_country").agg(F.sum("quantity").cast("long").alias("total_quantity"))

    def quantity_total(self) -> DataFrame:
        return self.sums().agg(F.sum("quantity").cast("long").alias("total_quantity"))

    def amount_by_territory_city(self) -> DataFrame:
        return self.sums().groupBy("locality_territory", "locality_city").agg(
            F.sum("amount").cast(MONEY_SUM).cast("double").alias("total_amount"))
