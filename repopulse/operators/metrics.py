"""Engagement score and headline values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.numbers import count_where, min_max, ratio_half_even, ratio_half_up
from repopulse.functions.time import WEEKDAYS, weekday_name_of, weekday_number
from repopulse.operators.activity import with_totals

SCORED = {"downloads": "norm_downloads", "likes": "norm_likes", "total_discussions": "norm_discussions"}


def bounds(df: DataFrame, *columns: str) -> DataFrame:
    """One row: ``<column>_min`` and ``<column>_max`` over all rows."""
    return df.agg(
        *(F.min(c).alias(f"{c}_min") for c in columns), *(F.max(c).alias(f"{c}_max") for c in columns)
    )


def engagement(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Mean of the min-max scaled downloads, likes and discussion counts of every repository.

    The bounds come from a scalar subquery: partial minima and maxima per task and one row at the
    end, where an unpartitioned window would pull all repositories into one task. The extremes of
    the discussion count are taken on structs that start with it and hold the other counts too.
    The subquery then needs the same columns as the main query, so both use one shuffle of the
    discussions and the table is read once.
    """
    base = with_totals(repos, discussions, "model_id", "tag", "likes", "downloads")
    totals = F.struct("total_discussions", "closed_discussions", "open_discussions")
    ranked = base.withColumn("total_discussions", totals)
    # A column of its own, so that the plan has one subquery and not one for every mention.
    base = base.withColumn("_limits", bounds(ranked, *SCORED).select(F.struct("*")).scalar())

    def limit(column: str, side: str) -> Column:
        value = F.col("_limits")[f"{column}_{side}"]
        return value["total_discussions"] if column == "total_discussions" else value

    scaled = base.withColumns(
        {alias: min_max(F.col(c), limit(c, "min"), limit(c, "max")) for c, alias in SCORED.items()}
    ).drop("_limits")
    score = F.col("norm_downloads") + F.col("norm_likes") + F.col("norm_discussions")
    return scaled.withColumns(
        {
            "engagement_score": score / 3,
            "closure_rate": ratio_half_even(F.col("closed_discussions"), F.col("total_discussions"), 3),
        }
    )


def top_by_engagement(repos: DataFrame, discussions: DataFrame, n: int = 10) -> DataFrame:
    return (
        engagement(repos, discussions)
        .select("model_id", "tag", "downloads", "likes", "total_discussions", "closure_rate", "engagement_score")
        .orderBy(F.desc("engagement_score"), "model_id")
        .limit(n)
    )


def popularity_correlation(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Pearson correlation of downloads with discussion counts over all repositories."""
    return with_totals(repos, discussions, "model_id", "downloads").agg(
        F.corr(F.col("downloads").cast("double"), F.col("total_discussions").cast("double")).alias("correlation"),
        F.count(F.lit(1)).alias("repos"),
    )


def headline(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """One row with the busiest repository and weekdays and the best closure rate.

    One pass over the discussions: each repository collapses to its totals and its counts per
    weekday, and everything else is an aggregate of those rows. Ties go to the smaller name and
    the earlier weekday.
    """
    created = weekday_number(F.col("created_at"))
    closed = weekday_number(F.col("closed_at"))
    is_closed = F.col("status") == "closed"
    days = range(len(WEEKDAYS))
    per_repo = discussions.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("total"),
        count_where(is_closed).alias("closed"),
        *(count_where(created == d).alias(f"created_{d}") for d in days),
        *(count_where(is_closed & (closed == d)).alias(f"closed_{d}") for d in days),
    )
    # Weekday totals count discussions whose repository is unknown too, so repositories are
    # attached from the left and the named results skip the rows without a name.
    joined = per_repo.join(repos.select(F.col("id").alias("repo_id"), "model_id"), "repo_id", "left")
    known = F.col("model_id").isNotNull()
    rate = ratio_half_up(F.col("closed"), F.col("total"), 2)
    one_row = joined.agg(
        F.max(F.when(known, F.col("total"))).alias("top_count"),
        F.max(F.when(known, rate)).alias("top_rate"),
        *(F.sum(f"created_{d}").alias(f"created_{d}") for d in days),
        *(F.sum(f"closed_{d}").alias(f"closed_{d}") for d in days),
        F.min_by(F.when(known, F.col("model_id")), F.when(known, F.struct(-F.col("total"), "model_id"))).alias("top_repo"),
        F.min_by(F.when(known, F.col("model_id")), F.when(known, F.struct(-rate, "model_id"))).alias("top_rate_repo"),
    )
    created_days = F.array(*(F.col(f"created_{d}") for d in days))
    closed_days = F.array(*(F.col(f"closed_{d}") for d in days))

    def busiest(counts: Column) -> Column:
        position = F.array_position(counts, F.array_max(counts)).cast("int")
        return F.when(F.array_max(counts) > 0, weekday_name_of(position - 1))

    return one_row.select(
        F.col("top_repo").alias("busiest_repo"),
        F.col("top_count").alias("busiest_repo_discussions"),
        busiest(created_days).alias("busiest_created_weekday"),
        F.array_max(created_days).alias("busiest_created_count"),
        busiest(closed_days).alias("busiest_closed_weekday"),
        F.array_max(closed_days).alias("busiest_closed_count"),
        F.col("top_rate_repo").alias("best_closure_repo"),
        F.col("top_rate").alias("best_closure_rate"),
    )
