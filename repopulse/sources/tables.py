"""Stored tables. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.schemas import empty_table, enforce


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty one where none has been written yet."""
    if path is None:
        return empty_table(spark, schema)
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def read_jdbc(spark: SparkSession, url: str, table: str, schema: T.StructType, **options: str) -> DataFrame:
    """A table of a relational database. Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` for anything large, or the whole table is read by one task."""
    # Cast only: the test for nulls belongs to writing, and would keep filters from reaching the database.
    stored = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return stored.select(*(F.col(f.name).cast(f.dataType) for f in schema))


def write_table(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Write to a new path and return the stored table. An existing path is an error: a table may
    be part of the plan that computes its successor, so it is replaced by a new folder."""
    enforce(df, schema).write.mode("errorifexists").parquet(path)
    return read_table(df.sparkSession, path, schema)
