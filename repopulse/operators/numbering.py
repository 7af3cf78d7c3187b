"""Dense numbers and running totals over ordered rows, without one task that sees all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.session import settle

#: Where a row lies once it is written: its partition, and its place there.
PART, PLACE = "_part", "_place"


def _laid_out(df: DataFrame, order: tuple[Column | str, ...]) -> DataFrame:
    """The rows in ranges of the order, written out with their places, so that a rerun task cannot move them."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.expr("monotonically_increasing_id() & 8589934591")
    return settle(ranged.select("*", F.spark_partition_id().alias(PART), place.alias(PLACE)))


def with_offsets(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add the sums over all earlier partitions (column ``_part``): a table of one row for each, which bounds its size."""
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(PART).agg(*(total.alias(name) for name, total in sums.items()))
    offsets = totals.select(PART, *(F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums))
    return rows.join(F.broadcast(offsets), PART)


def numbered(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Add numbers from 0 in the given order: one sort by ranges, one pass, no window over rows.

    Rows that tie in the order get numbers in no stated order.
    """
    rows = with_offsets(_laid_out(df, order), {"_offset": F.count(F.lit(1))})
    return rows.withColumn(name, F.col("_offset") + F.col(PLACE)).drop(PART, PLACE, "_offset")


def running_totals(df: DataFrame, totals: dict[str, Column], *order: Column | str) -> DataFrame:
    """Add for each entry of ``totals`` the sum of its value over all earlier rows of the given order."""
    earlier = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    values = {f"_value_{name}": value for name, value in totals.items()}
    rows = _laid_out(df.withColumns(values), order)
    rows = with_offsets(rows, {f"_offset_{name}": F.sum(f"_value_{name}") for name in totals})
    found = {name: F.coalesce(F.sum(f"_value_{name}").over(earlier), F.lit(0)) + F.col(f"_offset_{name}") for name in totals}
    return rows.withColumns(found).drop(PART, PLACE, *values, *(f"_offset_{name}" for name in totals))
