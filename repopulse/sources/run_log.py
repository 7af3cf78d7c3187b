"""Run logs: JSON reports of prompts, each with the runs of every backend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.numbers import count_where, round_half_even
from repopulse.schemas import RUN_LOG


def read_run_log(spark: SparkSession, *paths: str, multi_line: bool = True) -> DataFrame:
    """Reports as written, one per file; with ``multi_line=False`` one per line, which splits. See ``read_prompts`` for long ones."""
    return spark.read.schema(RUN_LOG).option("multiLine", multi_line).json(list(paths))


def read_prompts(spark: SparkSession, *paths: str, indent: int = 2) -> DataFrame:
    """Prompts of reports that were written with an indentation, one row each.

    Files are cut before every record of the list ``prompts``, which begins with a line of its own: no text in
    JSON holds a line break, and what lies deeper is indented further. So a report of any length is read by as many
    tasks as its bytes ask for, and files may hold one report after another. A report of another layout,
    a record that does not end and one that is no JSON fail the job; use ``read_run_log`` for other layouts.
    """
    margin = "\n" + " " * (2 * indent)
    text = spark.read.option("lineSep", margin + "{\n").text(list(paths)).select(F.col("value").alias("_text"))
    # What comes before the first record of a file starts at the margin; records do not.
    head = F.col("_text").startswith("{")
    empty = r'\A(\{\s*"prompts":\s*\[\s*\]\s*\}\s*)*(\{\s*"prompts":\s*\[)?\s*\z'
    record = F.concat(F.lit("{"), F.substring_index("_text", margin + "}", 1), F.lit("\n}"))
    checked = (
        F.when(head & F.col("_text").rlike(empty), F.lit(None))
        .when(~head & F.contains("_text", F.lit(margin + "}")), record)
        .otherwise(F.raise_error(F.concat(F.lit("not a record of an indented report: "), F.substring("_text", 1, 80))))
    )
    prompt = RUN_LOG["prompts"].dataType.elementType
    parsed = text.select(F.from_json(checked, prompt, {"mode": "FAILFAST"}).alias("_prompt"))
    return parsed.where(F.col("_prompt").isNotNull()).select("_prompt.*")


def flatten_runs(log: DataFrame) -> DataFrame:
    """One row per run, with the values of its prompt."""
    return runs_of(log.select(F.inline("prompts")))


def runs_of(prompts: DataFrame) -> DataFrame:
    """One row per run of every prompt, with the values of the prompt."""
    return prompts.select("prompt", "code_generation_seconds", "code_chars", F.inline("runs"))


def backend_summary(runs: DataFrame) -> DataFrame:
    """Runs, share of successful ones and mean seconds of each backend."""
    total = F.count(F.lit(1))
    return runs.groupBy("backend").agg(
        total.alias("runs"),
        count_where(F.col("ok")).alias("ok_runs"),
        (count_where(F.col("ok")) / total).alias("ok_rate"),
        round_half_even(F.avg("elapsed_seconds"), 3).alias("mean_elapsed_seconds"),
    )
