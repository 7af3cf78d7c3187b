"""Counts by repository, day, week and weekday.

Every count is taken on the narrow discussion columns, keyed by ``repo_id``, before the repository
table is touched. The partial aggregate runs on the map side, so a repository with a third of all
rows reaches the shuffle as one row per task and group, and the join that adds names works on
repositories or repository days, not on discussions. ``model_id`` is unique per ``id``, so counts
per ``repo_id`` are counts per ``model_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from repopulse.functions.numbers import count_where, ratio_half_up
from repopulse.functions.time import WEEKDAYS, week_start, weekday_name_of, weekday_number


def _named(counts: DataFrame, repos: DataFrame, *repo_columns: str, how: str = "inner") -> DataFrame:
    parent = repos.select(F.col("id").alias("repo_id"), *repo_columns)
    if how == "left":
        return parent.join(counts, "repo_id", "left")
    return counts.join(parent, "repo_id")


def repo_totals(discussions: DataFrame) -> DataFrame:
    """Total, closed and open discussions per ``repo_id``; other statuses count in the total only."""
    return discussions.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("total_discussions"),
        count_where(F.col("status") == "closed").alias("closed_discussions"),
        count_where(F.col("status") == "open").alias("open_discussions"),
    )


def with_totals(repos: DataFrame, discussions: DataFrame, *repo_columns: str) -> DataFrame:
    """Every repository with its totals, zeros where it has no discussion."""
    totals = ("total_discussions", "closed_discussions", "open_discussions")
    joined = _named(repo_totals(discussions), repos, *repo_columns, how="left")
    return joined.select(*repo_columns, *(F.coalesce(F.col(t), F.lit(0)).alias(t) for t in totals))


def discussions_per_repo(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    counts = discussions.groupBy("repo_id").agg(F.count(F.lit(1)).alias("discussion_count"))
    return _named(counts, repos, "model_id").select("model_id", "discussion_count")


def by_repo_and_weekday(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Counts per repository and creation weekday. ``weekday_order`` is 0 for Monday."""
    counts = (
        discussions.filter(F.col("created_at").isNotNull())
        .groupBy("repo_id", weekday_number(F.col("created_at")).alias("weekday_order"))
        .agg(F.count(F.lit(1)).alias("discussion_count"))
    )
    return _named(counts, repos, "model_id").select(
        "model_id", weekday_name_of(F.col("weekday_order")).alias("weekday"), "weekday_order", "discussion_count"
    )


def weekday_grid(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """One row per repository with discussions, one column per weekday, zero where there is none."""
    number = weekday_number(F.col("created_at"))
    counts = (
        discussions.filter(F.col("created_at").isNotNull())
        .groupBy("repo_id")
        .agg(*(count_where(number == i).alias(name) for i, name in enumerate(WEEKDAYS)))
    )
    return _named(counts, repos, "model_id").select("model_id", *WEEKDAYS)


def _by_weekday(discussions: DataFrame, date_col: str, alias: str, keep: Column) -> DataFrame:
    return (
        discussions.filter(keep & F.col(date_col).isNotNull())
        .groupBy(weekday_number(F.col(date_col)).alias("weekday_order"))
        .agg(F.count(F.lit(1)).alias(alias))
        .select(weekday_name_of(F.col("weekday_order")).alias("weekday"), "weekday_order", alias)
    )


def created_by_weekday(discussions: DataFrame) -> DataFrame:
    return _by_weekday(discussions, "created_at", "total_discussions", F.lit(True))


def closed_by_weekday(discussions: DataFrame) -> DataFrame:
    """Closures need both the status and the time; the status is compared as stored."""
    return _by_weekday(discussions, "closed_at", "closed_discussions", F.col("status") == "closed")


def closure_rates(repos: DataFrame, discussions: DataFrame, *repo_columns: str) -> DataFrame:
    """Totals and two-digit closure rate of every repository, rate null when it has no discussion."""
    return with_totals(repos, discussions, *(repo_columns or ("model_id",))).withColumn(
        "closure_rate",
        ratio_half_up(F.col("closed_discussions"), F.col("total_discussions"), 2),
    )


def daily_totals(discussions: DataFrame) -> DataFrame:
    return (
        discussions.filter(F.col("created_at").isNotNull())
        .groupBy(F.to_date("created_at").alias("day"))
        .agg(F.count(F.lit(1)).alias("total_discussions"))
    )


def daily_by_repo_id(discussions: DataFrame, date_col: str = "created_at") -> DataFrame:
    """Counts per ``repo_id`` and day that has any; a repository has at most one row per day."""
    return (
        discussions.filter(F.col(date_col).isNotNull())
        .groupBy("repo_id", F.to_date(date_col).alias("day"))
        .agg(F.count(F.lit(1)).alias("daily_discussions"))
    )


def daily_per_repo(repos: DataFrame, discussions: DataFrame, date_col: str = "created_at") -> DataFrame:
    return _named(daily_by_repo_id(discussions, date_col), repos, "model_id").select(
        "model_id", "day", "daily_discussions"
    )


def closed_per_week(discussions: DataFrame) -> DataFrame:
    return (
        discussions.filter((F.col("status") == "closed") & F.col("closed_at").isNotNull())
        .groupBy(week_start(F.col("closed_at")).alias("week"))
        .agg(F.count(F.lit(1)).alias("closed_discussions"))
    )


def weekly_closure_rate(discussions: DataFrame) -> DataFrame:
    """By week of creation: how many were opened and which share of them is closed."""
    return (
        discussions.filter(F.col("created_at").isNotNull())
        .groupBy(week_start(F.col("created_at")).alias("week"))
        .agg(
            F.count(F.lit(1)).alias("total_discussions"),
            count_where(F.col("status") == "closed").alias("closed_discussions"),
        )
        .withColumn("closure_rate", ratio_half_up(F.col("closed_discussions"), F.col("total_discussions"), 2))
    )


def open_and_closed(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Stacked form of the totals: one row per repository and status."""
    return with_totals(repos, discussions, "model_id").unpivot(
        "model_id",
        [F.col("open_discussions").alias("open"), F.col("closed_discussions").alias("closed")],
        "status",
        "discussion_count",
    )


def share_of_total(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Percentage of all discussions that belongs to each repository.

    The total is a scalar subquery over the counts: one value, computed once, no join.
    """
    counts = discussions_per_repo(repos, discussions)
    total = counts.select(F.sum("discussion_count")).scalar()
    return counts.withColumn("percent", F.col("discussion_count") * 100.0 / total)


def row_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def concentration(repos: DataFrame, discussions: DataFrame, top: int = 4) -> DataFrame:
    """Cumulative percentage of all discussions held by the ``top`` busiest repositories.

    The windows only see the ``top`` rows that the distributed top-k leaves.
    """
    counts = discussions_per_repo(repos, discussions)
    total = counts.select(F.sum("discussion_count")).scalar()
    order = (F.desc("discussion_count"), F.asc("model_id"))
    leaders = counts.orderBy(*order).limit(top)
    so_far = F.sum("discussion_count").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return leaders.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "model_id",
        "discussion_count",
        so_far.alias("cumulative_count"),
        (so_far * 100.0 / total).alias("cumulative_percent"),
    )
