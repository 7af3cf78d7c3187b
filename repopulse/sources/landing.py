"""Landing files: listing records as JSON lines, one record per repository or discussion.

A discussion record with ``fetch_error`` says that reading its repository failed at that point;
records delivered before the failure are valid. Take unreadable records out with ``split_unreadable``
first: they have messages of their own, and no row is made of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.numbers import whole_number
from repopulse.functions.text import listed_status
from repopulse.functions.time import parse_iso
from repopulse.operators.ranking import top_listings
from repopulse.schemas import DISCUSSION_LISTING, MODEL_LISTING


def read_model_listings(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(MODEL_LISTING).json(list(paths))


def read_discussion_listings(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(DISCUSSION_LISTING).json(list(paths))


def concatenate(*listings: DataFrame) -> DataFrame:
    """All records of several listings, repeated ones included."""
    return reduce(DataFrame.unionByName, listings)


MODEL_COUNTS, DISCUSSION_COUNTS = ("likes", "downloads", "seq"), ("num", "seq")


def split_unreadable(listings: DataFrame, counts: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Usable records, and one message for each line that is no record, or has a count that is no number or a flag that is none."""
    name = "id" if "id" in listings.columns else "model_id"
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in listings.columns else F.lit(None).cast("string")
    said = F.when(corrupt.isNotNull(), F.concat(F.lit("unreadable record: "), corrupt))
    read = {c: whole_number(F.col(c)) for c in counts if c in listings.columns}
    if "is_pull_request" in listings.columns:
        read["is_pull_request"] = _flag("is_pull_request")
    for column, value in read.items():
        bad = F.col(column).isNotNull() & value.isNull()
        said = said.when(bad, F.concat(F.lit(f"unusable {column}: "), F.col(column).cast("string")))
    judged = listings.withColumn("_said", said)
    messages = judged.filter("_said IS NOT NULL").select(F.col(name).alias("model_id"), F.col("_said").alias("message"))
    return judged.filter("_said IS NULL").drop("_said"), messages


def _flag(name: str) -> Column:
    return F.col(name).cast("string").try_cast("boolean")


def _kept(names: tuple[str, ...]) -> list[Column]:
    return [whole_number(F.col(c)).alias(c) if c == "seq" else F.col(c) for c in names]


def _count(name: str) -> Column:
    return F.coalesce(whole_number(F.col(name)), F.lit(0)).alias(name)


def model_rows(listings: DataFrame, *keep: str) -> DataFrame:
    """Flat repository rows; missing counts become 0, times that do not parse null."""
    return listings.select(
        F.col("id").alias("model_id"),
        "tag",
        "author",
        _count("likes"),
        _count("downloads"),
        "pipeline_tag",
        *(parse_iso(F.col(c)).alias(c) for c in ("created_at", "last_modified")),
        *_kept(keep),
    )


def top_model_rows(listings: DataFrame, tags: list[str] | None = None, n: int = 5) -> DataFrame:
    """Rows of the ``n`` most downloaded repositories per tag; one may occur under several tags."""
    return top_listings(model_rows(listings), tags, n)


def split_errors(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that were delivered, and one message per failure."""
    failed = F.col("fetch_error").isNotNull()
    messages = listings.filter(failed).select(
        "model_id", F.concat_ws(": ", "model_id", "fetch_error").alias("message")
    )
    return listings.filter(~failed), messages


def discussion_rows(listings: DataFrame, *keep: str, fold_status: bool = False) -> DataFrame:
    """Flat discussion rows; number 0, title '' and pull-request flag false where missing.

    ``fold_status`` reduces the status to open or closed right here, where surrounding blanks
    still make it open; otherwise it is left to cleaning.
    """
    status = F.coalesce(F.col("status"), F.lit("open"))
    return listings.select(
        "model_id",
        F.coalesce(whole_number(F.col("num")), F.lit(0)).alias("hf_discussion_num"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        "author",
        F.coalesce(_flag("is_pull_request"), F.lit(False)).alias("is_pull_request"),
        (listed_status(status) if fold_status else status).alias("status"),
        *(parse_iso(F.col(c)).alias(c) for c in ("created_at", "closed_at")),
        *_kept(keep),
    )
