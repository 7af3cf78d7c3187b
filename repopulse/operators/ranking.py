"""Top-k reports. Every order ends with the natural key, so equal values have one order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Spark applies the row-number limit within each task before the shuffle, so a group with a
    third of all rows sends at most ``n`` rows per task.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def top_listings(listings: DataFrame, tags: list[str] | None = None, n: int = 5) -> DataFrame:
    """The ``n`` most downloaded repositories under each tag, of the named tags or of all."""
    if tags is not None:
        listings = listings.filter(F.col("tag").isin(*tags))
    order = [F.col("downloads").desc_nulls_last(), F.col("model_id").asc()]
    return top_per_group(listings, "tag", order, n)


def latest_per_key(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """The row with the greatest ``sequence`` of each key.

    The other columns decide between equal or missing sequences, so every run keeps the same row.
    """
    rest = [c for c in df.columns if c not in (*keys, *sequence)]
    order = [F.desc_nulls_last(c) for c in (*sequence, *rest)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
