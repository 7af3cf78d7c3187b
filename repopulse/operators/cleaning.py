"""Row cleaning for repository and discussion records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions.numbers import non_negative
from repopulse.functions.text import canonical_status, optional_string, required_string, strip
from repopulse.functions.time import weekday_name


def clean_models(raw: DataFrame) -> DataFrame:
    """Drop rows without ``model_id`` or ``tag`` and normalise the rest.

    The test for emptiness comes before stripping: a blank-only key stays and becomes ''.
    Further columns, such as a load sequence, pass through.
    """
    return raw.filter((F.col("model_id") != "") & (F.col("tag") != "")).withColumns(
        {
            "model_id": strip(F.col("model_id")),
            "tag": strip(F.col("tag")),
            "author": optional_string(F.col("author")),
            "likes": non_negative(F.col("likes")),
            "downloads": non_negative(F.col("downloads")),
            "pipeline_tag": optional_string(F.col("pipeline_tag")),
        }
    )


def clean_discussions(raw: DataFrame) -> DataFrame:
    """Drop rows without ``model_id`` or number (0 is a number) and normalise the rest."""
    kept = raw.filter((F.col("model_id") != "") & F.col("hf_discussion_num").isNotNull())
    return add_weekday(
        kept.withColumns(
            {
                "model_id": strip(F.col("model_id")),
                "hf_discussion_num": F.col("hf_discussion_num").cast("long"),
                "title": required_string(F.col("title")),
                "author": optional_string(F.col("author")),
                "is_pull_request": F.coalesce(F.col("is_pull_request"), F.lit(False)),
                "status": canonical_status(F.col("status")),
            }
        )
    )


def add_weekday(df: DataFrame) -> DataFrame:
    """``weekday`` name of ``created_at``, null where that is null."""
    return df.withColumn("weekday", weekday_name(F.col("created_at")))
