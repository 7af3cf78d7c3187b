"""The three derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.time import weekday_name
from repopulse.operators.activity import by_repo_and_weekday, closure_rates
from repopulse.operators.joins import with_repo

# The names the derived tables are known by.
VIEW_NAMES = ("v_discussions_clean", "v_model_discussion_summary", "v_discussions_by_weekday")


def discussions_clean(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Discussions with repository name, folded status, closed flag and both weekday names.

    The status only loses outer spaces here, as SQL ``TRIM`` does.
    """
    status = F.lower(F.trim("status"))
    return with_repo(discussions, repos, "model_id").select(
        "id",
        "repo_id",
        "model_id",
        "hf_discussion_num",
        "title",
        "author",
        "is_pull_request",
        status.alias("status"),
        (status == "closed").alias("is_closed"),
        "created_at",
        "closed_at",
        weekday_name(F.col("created_at")).alias("weekday_created"),
        weekday_name(F.col("closed_at")).alias("weekday_closed"),
    )


def discussion_summary(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Closure rates with the tag and popularity of the repository."""
    return closure_rates(repos, discussions, "model_id", "tag", "likes", "downloads")


def discussions_by_weekday(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """Counts of the cleaned table per repository and creation weekday, taken before the join."""
    return by_repo_and_weekday(repos, discussions).drop("weekday_order")


def create_views(spark: SparkSession, repos: DataFrame, discussions: DataFrame) -> None:
    """Register base tables and derived tables for SQL, replacing earlier ones."""
    repos.createOrReplaceTempView("model_repos")
    discussions.createOrReplaceTempView("discussions")
    frames = (
        discussions_clean(repos, discussions),
        discussion_summary(repos, discussions),
        discussions_by_weekday(repos, discussions),
    )
    for name, frame in zip(VIEW_NAMES, frames, strict=True):
        frame.createOrReplaceTempView(name)
