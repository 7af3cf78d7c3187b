"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8,000 bytes; a wide projection is faster in parts.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Fits run one series at a time in as many workers as there are cores.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is not set.

    Every executor must be able to read what another wrote; both settings name shared folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    The rows are computed once, and a lost executor costs nothing that was computed before.
    """
    path = f"{shared_folder(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(field: T.StructField) -> Column:
    """About the bytes of a value in memory: eight for a number, lengths for texts and lists."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(8 * F.size(column), F.lit(0)) + 32
    return F.lit(8)


def small_side(df: DataFrame, most_rows: int = 100_000, most_bytes: int = 32 << 20) -> DataFrame:
    """A settled frame, marked for broadcast if its counted rows and their measured bytes are within both bounds.

    Beyond them it is a plain frame, and Spark joins it by a shuffle. Lists count eight bytes an entry.
    """
    seen = Observation()
    size = sum((_row_bytes(f) for f in df.schema), F.lit(0).cast("bigint"))
    kept = settle(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")))
    small = seen.get["rows"] <= most_rows and (seen.get["bytes"] or 0) <= most_bytes
    return F.broadcast(kept) if small else kept
