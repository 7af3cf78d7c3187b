"""Joins of discussions to their repository.

No join here carries a broadcast hint. The repository side grows with the data, so the choice is
left to the size check Spark makes itself (statistics against ``autoBroadcastJoinThreshold``, then
measured shuffle sizes under adaptive execution). Above that bound the sort-merge join splits a
repository that holds a large share of all rows (``spark.sql.adaptive.skewJoin``).

Reports do not join rows at all: they aggregate by ``repo_id`` first and attach names to the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from repopulse.functions.time import parse_iso


def with_repo(discussions: DataFrame, repos: DataFrame, *repo_columns: str) -> DataFrame:
    """Discussion rows plus the named repository columns; rows without a repository drop out."""
    parent = repos.select(F.col("id").alias("repo_id"), *repo_columns)
    return discussions.join(parent, "repo_id")


def _wall_time(df: DataFrame, name: str) -> Column:
    """A text column read as ISO times in UTC; a typed one as it is."""
    text = isinstance(df.schema[name].dataType, StringType)
    return (parse_iso(F.col(name)) if text else F.col(name).cast("timestamp_ntz")).alias(name)


def joined_activity(discussions: DataFrame, repos: DataFrame) -> DataFrame:
    """Projection the forecasts read. Times that arrive as text and do not parse become null."""
    return with_repo(discussions, repos, "model_id").select(
        "model_id",
        "is_pull_request",
        "status",
        *(_wall_time(discussions, name) for name in ("created_at", "closed_at")),
    )


def denormalised(discussions: DataFrame, repos: DataFrame) -> DataFrame:
    """All columns of both tables; names that occur in both get ``_disc`` and ``_model``."""
    shared = set(discussions.columns) & set(repos.columns)
    left = discussions.select(*(F.col(c).alias(f"{c}_disc" if c in shared else c) for c in discussions.columns))
    right = repos.select(*(F.col(c).alias(f"{c}_model" if c in shared else c) for c in repos.columns))
    return left.join(right, F.col("repo_id") == F.col("id_model" if "id" in shared else "id"))


def resolve_repo(rows: DataFrame, repos: DataFrame) -> DataFrame:
    """Replace ``model_id`` by the ``repo_id`` it stands for; unknown repositories drop out."""
    parent = repos.select("model_id", F.col("id").alias("repo_id"))
    return rows.join(parent, "model_id").drop("model_id")


def orphans(rows: DataFrame, repos: DataFrame) -> DataFrame:
    """Rows that ``resolve_repo`` leaves out, one line per unknown repository with its row count.

    Counted before the join, so that an unknown repository with very many rows is one row there.
    """
    counts = rows.groupBy("model_id").agg(F.count(F.lit(1)).alias("skipped_rows"))
    return counts.join(repos.select("model_id"), "model_id", "left_anti")
