"""Table schemas. Stored times are UTC wall times without a zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL_REPOS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("model_id", T.StringType(), False),
        T.StructField("tag", T.StringType(), False),
        T.StructField("author", T.StringType()),
        T.StructField("likes", T.LongType(), False),
        T.StructField("downloads", T.LongType(), False),
        T.StructField("pipeline_tag", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_modified", T.TimestampNTZType()),
    ]
)

DISCUSSIONS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("repo_id", T.LongType(), False),
        T.StructField("hf_discussion_num", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("author", T.StringType()),
        T.StructField("is_pull_request", T.BooleanType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("closed_at", T.TimestampNTZType()),
    ]
)

# Landing records: every value as the text that was delivered, so that nothing is lost by its spelling
# and a line is unreadable whichever columns a query needs. ``seq`` orders the records of one delivery; of two records with the same key the
# later one counts. A line that is no such record is kept as it is in ``_corrupt_record``.
MODEL_LISTING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("likes", T.StringType()),
        T.StructField("downloads", T.StringType()),
        T.StructField("pipeline_tag", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("last_modified", T.StringType()),
        T.StructField("seq", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

DISCUSSION_LISTING = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("num", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("is_pull_request", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("closed_at", T.StringType()),
        T.StructField("fetch_error", T.StringType()),
        T.StructField("seq", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField(
            "prompts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("prompt", T.StringType()),
                        T.StructField("code_generation_seconds", T.DoubleType()),
                        T.StructField("code_chars", T.LongType()),
                        T.StructField(
                            "runs",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("backend", T.StringType()),
                                        T.StructField("label", T.StringType()),
                                        T.StructField("ok", T.BooleanType()),
                                        T.StructField("elapsed_seconds", T.DoubleType()),
                                        T.StructField("stdout_len", T.LongType()),
                                        T.StructField("stderr_len", T.LongType()),
                                        T.StructField("notes", T.StringType()),
                                        T.StructField("stderr_preview", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

# Values taken by a required column that a row leaves out.
DEFAULTS = {"likes": 0, "downloads": 0, "is_pull_request": False, "status": "open"}


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``.

    Absent columns take their default or null, other columns are dropped. A null in a required
    column fails the job when the row is computed, as a NOT NULL constraint would.
    """
    columns = []
    for field in schema:
        if field.name in df.columns:
            column = F.col(field.name).cast(field.dataType)
        else:
            column = F.lit(DEFAULTS.get(field.name)).cast(field.dataType)
        if not field.nullable:
            message = f"null in required column {field.name}"
            column = F.when(column.isNull(), F.raise_error(F.lit(message)).cast(field.dataType)).otherwise(column)
        columns.append(column.alias(field.name))
    return df.select(columns)
