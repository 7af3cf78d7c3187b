"""The load job: landing records to cleaned batches to upserted tables, with a run summary.

Landing JSON is parsed once, into cleaned Parquet batches in the target folder; the upserts then
read those by column. Nothing is collected but four row counts. Each step is a written table, so a
lost executor costs the tasks it held and a rerun of the job starts from files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from repopulse.operators.cleaning import clean_discussions, clean_models
from repopulse.operators.joins import resolve_repo
from repopulse.operators.upsert import (
    DISCUSSION_FIELDS,
    DISCUSSION_KEYS,
    MODEL_KEYS,
    touched_rows,
    upsert,
    upsert_models,
)
from repopulse.schemas import DISCUSSIONS, MODEL_REPOS
from repopulse.session import settle
from repopulse.sources.buckets import BUCKET_ROWS, open_table
from repopulse.sources.landing import (
    DISCUSSION_COUNTS,
    MODEL_COUNTS,
    discussion_rows,
    model_rows,
    split_errors,
    split_unreadable,
    top_listings,
)

#: Key buckets of a new table; they split as it grows.
BUCKETS = 64

MESSAGES = "model_id string, message string"
UNREADABLE = "model_id string, message string, source string"


@dataclass(frozen=True)
class Loaded:
    """Tables after the load, and the summary as rows ``section, item, value``."""

    repos: DataFrame
    discussions: DataFrame
    summary: DataFrame


def _stage(rows: DataFrame, clean, name: str, path: str) -> tuple[DataFrame, int, int]:
    """Write the cleaned batch; count rows before and after cleaning on the way."""
    seen, kept = Observation(f"{name}_seen"), Observation(f"{name}_cleaned")
    count = F.count(F.lit(1)).alias("n")
    cleaned = clean(rows.observe(seen, count)).observe(kept, count)
    cleaned.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.schema(cleaned.schema).parquet(path), seen.get["n"], kept.get["n"]


def load(
    model_listings: DataFrame,
    discussion_listings: DataFrame,
    target: str,
    current: str | None = None,
    tags: list[str] | None = None,
    top_n: int | None = None,
    fold_status: bool = False,
    notes: Sequence[str] = (),
    buckets: int = BUCKETS,
    bucket_rows: int = BUCKET_ROWS,
) -> Loaded:
    """Bring ``model_repos`` and ``discussions`` below ``current`` up to date in the new folder ``target``.

    Without ``current`` the tables start empty. Repositories are stored before discussions, as two
    writes, so a failure in the second leaves the first. ``top_n`` keeps the most downloaded
    repositories per tag, of ``tags`` or of all. ``fold_status`` reduces the status before cleaning, as
    ``discussion_rows`` does. Records that cannot be read are counted and listed, and load nothing.
    ``notes`` go into the summary. New tables get ``buckets`` key buckets, a power of two, which split where
    they may exceed ``bucket_rows`` rows; a load rewrites those that its batch touches, and the new version
    points to the files of the others.
    """
    spark = model_listings.sparkSession
    model_listings, bad_models = split_unreadable(model_listings, MODEL_COUNTS)
    discussion_listings, bad_threads = split_unreadable(discussion_listings, DISCUSSION_COUNTS)
    bad = bad_models.withColumn("source", F.lit("models")).unionByName(bad_threads.withColumn("source", F.lit("discussions")))
    bad.write.mode("errorifexists").parquet(f"{target}/unreadable")
    models = model_rows(model_listings, "seq")
    if tags is not None or top_n is not None:
        models = top_listings(models, tags, top_n) if top_n is not None else models.filter(F.col("tag").isin(*tags))
    batch, models_seen, models_cleaned = _stage(models, clean_models, "models", f"{target}/clean_models")
    stored = open_table(spark, current and f"{current}/model_repos", MODEL_REPOS, MODEL_KEYS, buckets, bucket_rows)
    touched = stored.touched(batch)
    updated = upsert_models(stored.read(touched), batch, ["seq"], top_id=stored.top_id)
    repos = stored.replace(updated, touched, f"{target}/model_repos").read()

    delivered, errors = split_errors(discussion_listings)
    threads, threads_seen, threads_cleaned = _stage(
        discussion_rows(delivered, "seq", fold_status=fold_status), clean_discussions, "discussions", f"{target}/clean_discussions"
    )
    errors.write.mode("errorifexists").parquet(f"{target}/fetch_errors")
    stored = open_table(spark, current and f"{current}/discussions", DISCUSSIONS, DISCUSSION_KEYS, buckets, bucket_rows)
    known = settle(resolve_repo(threads, repos))
    touched = stored.touched(known)
    updated = upsert(stored.read(touched), known, list(DISCUSSION_KEYS), DISCUSSION_FIELDS, ["seq"], top_id=stored.top_id)
    discussions = stored.replace(updated, touched, f"{target}/discussions").read()

    counts = {
        "models_seen": models_seen,
        "models_cleaned": models_cleaned,
        "models_loaded": touched_rows(batch),
        "discussions_seen": threads_seen,
        "discussions_cleaned": threads_cleaned,
        "discussions_loaded": touched_rows(threads, repos),
    }
    unreadable = spark.read.schema(UNREADABLE).parquet(f"{target}/unreadable")
    counts |= {
        f"{source}_unreadable": unreadable.filter(F.col("source") == source).agg(F.count(F.lit(1)).alias("touched_rows"))
        for source in ("models", "discussions")
    }
    messages = spark.read.schema(MESSAGES).parquet(f"{target}/fetch_errors")
    return Loaded(repos, discussions, summary(counts, messages, unreadable, notes))


def summary(
    counts: dict[str, int | DataFrame], messages: DataFrame, unreadable: DataFrame, notes: Sequence[str] = ()
) -> DataFrame:
    """Counts, fetch errors, unreadable records and notes as rows ``section, item, value``.

    Errors stay rows: their number grows with the repositories, so they are not gathered into a list.
    """
    spark = messages.sparkSession
    known = [("count", name, str(n)) for name, n in counts.items() if not isinstance(n, DataFrame)]
    noted = [("limitation", f"note_{i}", text) for i, text in enumerate(notes, 1)]
    rows = spark.createDataFrame(known + noted, "section string, item string, value string")
    for name, frame in counts.items():
        if isinstance(frame, DataFrame):
            line = frame.select(
                F.lit("count").alias("section"), F.lit(name).alias("item"), F.col("touched_rows").cast("string").alias("value")
            )
            rows = rows.unionByName(line)
    for section, frame in (("fetch_error", messages), ("unreadable_record", unreadable)):
        rows = rows.unionByName(
            frame.select(F.lit(section).alias("section"), F.col("model_id").alias("item"), F.col("message").alias("value"))
        )
    return rows
