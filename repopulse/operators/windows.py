"""Trailing averages and spike detection over daily counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from repopulse.functions.numbers import round_half_even
from repopulse.operators.activity import daily_by_repo_id


def trailing_mean(window: int, calendar: bool = False) -> Column:
    """Mean of the current and the ``window - 1`` earlier rows of a repository.

    The frame counts rows, so days without discussions are no part of it. With ``calendar`` it
    counts days instead, still averaging over the days that have any.
    """
    spec = Window.partitionBy("repo_id").orderBy("day")
    if calendar:
        spec = Window.partitionBy("repo_id").orderBy(F.unix_date("day")).rangeBetween(-(window - 1), 0)
    else:
        spec = spec.rowsBetween(-(window - 1), 0)
    return F.avg("daily_discussions").over(spec)


def _with_mean(discussions: DataFrame, window: int, calendar: bool) -> DataFrame:
    # The window runs before names are attached: its partitions hold one row per day, and its
    # exchange by repo_id also serves the join when that is a sort-merge join.
    return daily_by_repo_id(discussions).withColumn("_mean", trailing_mean(window, calendar))


def rolling_average(repos: DataFrame, discussions: DataFrame, window: int = 7, calendar: bool = False) -> DataFrame:
    names = repos.select(F.col("id").alias("repo_id"), "model_id")
    return (
        _with_mean(discussions, window, calendar)
        .join(names, "repo_id")
        .select("model_id", "day", "daily_discussions", F.col("_mean").alias("rolling_7d_avg" if window == 7 else f"rolling_{window}d_avg"))
    )


def spikes(
    repos: DataFrame,
    discussions: DataFrame,
    window: int = 7,
    multiplier: float = 2.0,
    min_daily: int = 3,
    calendar: bool = False,
) -> DataFrame:
    """Days with at least ``min_daily`` discussions and ``multiplier`` times the trailing mean.

    The day itself is part of its mean. Thresholds are tested on the exact values, rounding comes
    after.
    """
    ratio = F.col("daily_discussions") / F.nullif(F.col("_mean"), F.lit(0.0))
    names = repos.select(F.col("id").alias("repo_id"), "model_id")
    return (
        _with_mean(discussions, window, calendar)
        .withColumn("_ratio", ratio)
        .filter((F.col("daily_discussions") >= min_daily) & (F.col("_ratio") >= multiplier))
        .join(names, "repo_id")
        .select(
            "model_id",
            "day",
            "daily_discussions",
            round_half_even(F.col("_mean"), 2).alias("rolling_avg"),
            round_half_even(F.col("_ratio"), 2).alias("spike_ratio"),
        )
    )
