"""Exchange of tables as CSV folders with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes are doubled inside quoted values, so that other readers understand them; every value may
# hold line breaks. A null is an empty cell, an empty string a quoted one.
_FORMAT = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_EMPTY = "\u0001"  # what a quoted empty cell reads as, to keep it apart from null


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").options(**_FORMAT, **_TIME, emptyValue='""').csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed by ``schema``, both time columns included; a malformed value fails the job."""
    reader = spark.read.schema(schema).options(**_FORMAT, **_TIME, emptyValue=_EMPTY, mode="FAILFAST")
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    return reader.csv(path).withColumns(
        {name: F.when(F.col(name) == _EMPTY, "").otherwise(F.col(name)) for name in texts}
    )
