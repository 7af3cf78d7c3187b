"""Table checks. Every count is 0, never null, on an empty table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
VALID_STATUSES = ("open", "closed")

# The checks that only inform, then every check in report order with its description.
INFORMATIONAL = ("models.total_rows", "discussions.total_rows")
CHECKS = {
    "models.total_rows": "Total model rows loaded (informational, not a failure).",
    "discussions.total_rows": "Total discussion rows loaded (informational, not a failure).",
    "models.missing_model_id": "Rows in model_repos missing model_id.",
    "discussions.missing_repo_id": "Discussions with no parent repo id.",
    "discussions.missing_created_at": "Discussions with no creation timestamp.",
    "discussions.duplicate_per_repo": "Duplicate (repo_id, hf_discussion_num) pairs.",
    "discussions.invalid_status_values": "Status values outside the canonical set {open, closed}.",
    "discussions.closed_before_created": "Discussions whose closed_at precedes created_at.",
    "models.negative_likes": "Repos with negative like counts (should be impossible).",
    "models.negative_downloads": "Repos with negative download counts (should be impossible).",
}

def invalid_status(column: Column) -> Column:
    """True outside the valid set; a null status is outside it."""
    return ~F.coalesce(column.isin(*VALID_STATUSES), F.lit(False))


def _tally(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """One row: ``rows``, ``duplicates`` on ``keys`` and one count per condition.

    Conditions are counted where the rows are read, one row per task. Only the keys are shuffled, from a
    scan of their own columns (nulls form one key, as equal values); a key repeated very often is counted
    in one task, in one row of its table.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(c).alias(name) for name, c in conditions.items()),
    )
    return row.withColumn("duplicates", duplicate_count(df, keys).scalar() if keys else F.lit(0).cast("long"))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key.

    The keys are dealt into a named number of partitions: adaptive execution would merge them by their few
    bytes, and keys that come from a join would be counted in the tasks that sort for it.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*keys).repartition(partitions, *keys)
    per_key = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0).cast("long")).alias("duplicate_rows"))


def table_checks(repos: DataFrame, discussions: DataFrame, names: tuple[str, ...] = tuple(CHECKS)) -> DataFrame:
    """``check_name, offending_rows, description`` of all ten checks or the named ones, in report order.

    A table is read only if one of its checks is asked for; the duplicate check reads the two key
    columns again and shuffles nothing else.
    """
    conditions = {
        "models": {
            "missing_model_id": F.col("model_id").isNull(),
            "negative_likes": F.col("likes") < 0,
            "negative_downloads": F.col("downloads") < 0,
        },
        "discussions": {
            "missing_repo_id": F.col("repo_id").isNull(),
            "missing_created_at": F.col("created_at").isNull(),
            "invalid_status_values": invalid_status(F.col("status")),
            "closed_before_created": F.col("closed_at") < F.col("created_at"),
        },
    }
    columns = {"total_rows": "rows", "duplicate_per_repo": "duplicates"}

    def lines(table: str, df: DataFrame) -> DataFrame | None:
        asked = [name for name in CHECKS if name in names and name.startswith(f"{table}.")]
        if not asked:
            return None
        short = {name: name.split(".")[1] for name in asked}
        wanted = {c: condition for c, condition in conditions[table].items() if c in short.values()}
        keys = ["repo_id", "hf_discussion_num"] if "duplicate_per_repo" in short.values() else []
        entries = [
            F.struct(
                F.lit(list(CHECKS).index(name)).alias("position"),
                F.lit(name).alias("check_name"),
                F.col(columns.get(short[name], short[name])).alias("offending_rows"),
                F.lit(CHECKS[name]).alias("description"),
            )
            for name in asked
        ]
        return _tally(df, keys, wanted).select(F.inline(F.array(*entries)))

    found = [part for part in (lines("models", repos), lines("discussions", discussions)) if part is not None]
    return reduce(DataFrame.unionByName, found).orderBy("position").drop("position")


def failures(checks: DataFrame) -> DataFrame:
    """The checks that found something; the informational ones never fail."""
    return checks.filter(~F.col("check_name").isin(*INFORMATIONAL) & (F.col("offending_rows") > 0))


def summary(checks: DataFrame) -> DataFrame:
    """One row: number of failed checks and whether all passed."""
    return failures(checks).agg(F.count(F.lit(1)).alias("failed_checks")).withColumn(
        "all_passed", F.col("failed_checks") == 0
    )


def validate_discussions(df: DataFrame) -> DataFrame:
    """One row with four counts for a frame keyed by ``model_id, hf_discussion_num``.

    A check whose column is absent counts 0; duplicates are taken on the key columns present.
    """
    present = set(df.columns)
    conditions = {}
    if "model_id" in present:
        conditions["missing_model_id"] = F.col("model_id").isNull()
    if "created_at" in present:
        conditions["missing_created_at"] = F.col("created_at").isNull()
    if "status" in present:
        conditions["invalid_status_values"] = invalid_status(F.col("status"))
    keys = [k for k in ("model_id", "hf_discussion_num") if k in present]
    tally = _tally(df, keys, conditions)
    return tally.select(
        *(
            (F.col(name) if name in conditions else F.lit(0).cast("long")).alias(name)
            for name in ("missing_model_id", "missing_created_at")
        ),
        F.col("duplicates").alias("duplicate_discussions"),
        (F.col("invalid_status_values") if "status" in present else F.lit(0).cast("long")).alias("invalid_status_values"),
    )
