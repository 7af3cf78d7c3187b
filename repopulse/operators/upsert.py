"""Keyed upserts of a batch into a table.

A batch row replaces every mutable field of the stored row with its key, nulls included. Keys the
batch does not name stay as they are. When a batch repeats a key, the row with the greatest
sequence counts (or the job fails, in strict mode, if the key is a new one).

The batch is reduced to one row per key once and written to the shared folder; everything after
reads that. The stored table is read once in full and once for its keys, and not moved by a shuffle
unless it has to be: the batch is joined to it from the right (``left`` and ``left_semi``), so a
batch within Spark's broadcast bound never moves a stored row; beyond that bound both sides are
shuffled by key, and keys are unique on both sides, so no partition can be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.operators.joins import resolve_repo
from repopulse.operators.numbering import numbered
from repopulse.operators.ranking import latest_per_key
from repopulse.session import settle

MODEL_KEYS, DISCUSSION_KEYS = ("model_id",), ("repo_id", "hf_discussion_num")
MODEL_FIELDS = ("tag", "author", "likes", "downloads", "pipeline_tag", "created_at", "last_modified")
DISCUSSION_FIELDS = ("title", "author", "is_pull_request", "status", "created_at", "closed_at")


def with_new_ids(rows: DataFrame, keys: list[str], current: DataFrame, top_id: int | None = None) -> DataFrame:
    """Number rows with unique keys from the greatest stored id on, without gaps.

    The order is by key hash, so the numbers depend on the keys alone. Rows are dealt into ranges of
    the hash, sorted and written once; a number is a row's place in its range behind the counts of the
    ranges before it, so nothing is joined back and no step sorts all rows in one task. ``top_id`` is
    the greatest stored id where it is known.
    """
    top = F.lit(top_id) if top_id is not None else current.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    # Sixteen bytes sort as their hexadecimal digits do, in half the bytes shuffled and written.
    hashed = rows.withColumn("_hash", F.unhex(F.md5(F.concat_ws("/", *(F.col(k).cast("string") for k in keys)))))
    placed = numbered(hashed, "_number", "_hash", *keys)
    return placed.withColumn("id", (top + F.col("_number") + 1).cast("long")).drop("_hash", "_number")


def _checked_latest(batch: DataFrame, keys: list[str], sequence: list[str], current: DataFrame) -> DataFrame:
    """Latest row per key; fails on a key that is repeated and not stored yet."""
    latest = latest_per_key(batch, keys, sequence)
    stored = current.select(*keys).withColumn("_stored", F.lit(True))
    repeated = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).filter(F.col("_times") > 1)
    bad = repeated.join(stored, keys, "left_anti").withColumn("_bad", F.lit(True)).drop("_times")
    name = F.concat_ws("/", *(F.col(k).cast("string") for k in keys))
    return (
        latest.join(bad, keys, "left")
        .withColumn(
            keys[0],
            F.when(
                F.col("_bad"), F.raise_error(F.concat(F.lit("new key repeated in batch: "), name)).cast(latest.schema[keys[0]].dataType)
            ).otherwise(F.col(keys[0])),
        )
        .drop("_bad")
    )


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: list[str],
    fields: tuple[str, ...],
    sequence: list[str],
    on_duplicate: str = "last",
    top_id: int | None = None,
) -> DataFrame:
    """``current`` after the batch, with its own columns: ``id``, ``keys`` and ``fields``.

    ``current`` may be a part of the table that has all keys of the batch which the table has; then
    ``top_id`` is the greatest id of the whole table.
    """
    if on_duplicate not in ("last", "error"):
        raise ValueError("on_duplicate is 'last' or 'error'")
    batch = batch.select(*keys, *fields, *(c for c in sequence if c not in (*keys, *fields)))
    if on_duplicate == "error":
        latest = _checked_latest(batch, keys, sequence, current)
    else:
        latest = latest_per_key(batch, keys, sequence)
    latest = settle(latest.select(*keys, *fields))

    incoming = latest.select(*keys, F.struct(*fields).alias("_new"))
    kept = current.join(incoming, keys, "left").select(
        "id",
        *keys,
        *(F.when(F.col("_new").isNotNull(), F.col(f"_new.{f}")).otherwise(F.col(f)).alias(f) for f in fields),
    )
    stored_keys = current.select(*keys).join(latest.select(*keys), keys, "left_semi")
    added = with_new_ids(latest.join(stored_keys, keys, "left_anti"), keys, current, top_id)
    return kept.unionByName(added.select("id", *keys, *fields))


def upsert_actions(current: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per batch key with the action it causes: ``insert`` or ``update``."""
    wanted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("batch_rows"))
    hits = current.select(*keys).join(wanted.select(*keys), keys, "left_semi").withColumn("_hit", F.lit(True))
    return wanted.join(hits, keys, "left").select(
        *keys, "batch_rows", F.when(F.col("_hit"), "update").otherwise("insert").alias("action")
    )


def upsert_models(
    current: DataFrame, batch: DataFrame, sequence: list[str], on_duplicate: str = "last", top_id: int | None = None
) -> DataFrame:
    """Repositories keyed by ``model_id``."""
    return upsert(current, batch, list(MODEL_KEYS), MODEL_FIELDS, sequence, on_duplicate, top_id)


def upsert_discussions(
    current: DataFrame, repos: DataFrame, batch: DataFrame, sequence: list[str], on_duplicate: str = "last"
) -> DataFrame:
    """Discussions keyed by ``(repo_id, hf_discussion_num)``; rows of unknown repositories are skipped."""
    rows = resolve_repo(batch, repos)
    return upsert(current, rows, list(DISCUSSION_KEYS), DISCUSSION_FIELDS, sequence, on_duplicate)


def touched_rows(batch: DataFrame, repos: DataFrame | None = None) -> DataFrame:
    """One row with the number of batch rows an upsert handles: input rows, not distinct keys."""
    if repos is None:
        return batch.agg(F.count(F.lit(1)).alias("touched_rows"))
    # Counted per repository before the join.
    counts = batch.groupBy("model_id").agg(F.count(F.lit(1)).alias("_n"))
    known = counts.join(repos.select("model_id"), "model_id", "left_semi")
    return known.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("touched_rows"))
