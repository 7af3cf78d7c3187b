"""Stored tables in key buckets that split as they grow, so that a load costs what its batch costs.

A version of a table is a folder with a small list: for each bucket its label, the folder of its rows,
which may belong to an earlier version, and their number. A load reads and rewrites the buckets that
its batch touches and points to the others. A touched bucket that could hold too many rows afterwards
is split by further bits of the key hash, so a bucket, and the task that writes it, stays at about the
bound however large the table gets. The list has one line per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.schemas import empty_table, enforce

LIST = "label bigint, path string, n_rows bigint, bucket_rows bigint, top_id bigint"
#: Rows from which a bucket is split.
BUCKET_ROWS = 2_000_000


@dataclass(frozen=True)
class Bucket:
    """Where the rows of a bucket lie, None if it has none, and how many they are."""

    path: str | None = None
    n_rows: int = 0


@dataclass(frozen=True)
class Stored:
    """One version of a table: its buckets by label, and the greatest id in it.

    A bucket of depth d holds the keys whose hash ends in its d bits; its label is those bits with a one
    before them, so the two halves of a bucket are labels of their own and labels never clash.
    """

    spark: SparkSession
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: dict[int, Bucket]
    bucket_rows: int
    top_id: int

    def _label(self, labels: set[int]) -> Column:
        """The label that a row's key falls under; every hash has exactly one."""
        hashed, by_depth = F.xxhash64(*self.keys), {}
        for label in sorted(labels):
            by_depth.setdefault(label.bit_length() - 1, []).append(label)
        ends = {depth: hashed.bitwiseAND(F.lit((1 << depth) - 1)) + F.lit(1 << depth) for depth in by_depth}
        return F.coalesce(*(F.when(ends[depth].isin(found), ends[depth]) for depth, found in sorted(by_depth.items()))).cast("bigint")

    def touched(self, batch: DataFrame) -> dict[int, int]:
        """Rows of a batch by bucket; never more entries than there are buckets."""
        counts = batch.groupBy(self._label(set(self.buckets)).alias("label")).agg(F.count(F.lit(1)).alias("n"))
        return {r["label"]: r["n"] for r in counts.collect()}

    def read(self, labels: dict[int, int] | None = None) -> DataFrame:
        """Rows of some buckets, or of all."""
        wanted = [b.path for label, b in sorted(self.buckets.items()) if b.path and (labels is None or label in labels)]
        return self.spark.read.schema(self.schema).parquet(*wanted) if wanted else empty_table(self.spark, self.schema)

    def _split(self, label: int, most: int) -> list[int]:
        """The labels in place of one whose bucket may come to hold ``most`` rows."""
        deeper = 0
        while most > self.bucket_rows << deeper:
            deeper += 1
        depth = label.bit_length() - 1
        bits = label - (1 << depth)
        return [(1 << (depth + deeper)) + (part << depth) + bits for part in range(1 << deeper)]

    def replace(self, rows: DataFrame, touched: dict[int, int], folder: str) -> Stored:
        """The version in the new folder in which ``rows`` are all rows of the touched buckets.

        A bucket holds its stored rows and at most one more for each row of the batch, which is known
        before anything is computed; from that it is split.
        """
        fresh = [x for label, n in touched.items() for x in self._split(label, self.buckets[label].n_rows + n)]
        kept = {label: b for label, b in self.buckets.items() if label not in touched}
        path = f"{folder}/rows"
        placed = enforce(rows, self.schema).withColumn("_bucket", self._label({*kept, *fresh}))
        placed.repartition("_bucket").write.mode("errorifexists").partitionBy("_bucket").parquet(path)
        schema = T.StructType([*self.schema.fields, T.StructField("_bucket", T.LongType())])
        written = self.spark.read.schema(schema).parquet(path).groupBy("_bucket")
        found = {r["_bucket"]: r for r in written.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top_id")).collect()}
        new = {label: Bucket(f"{path}/_bucket={label}", found[label]["n"]) if label in found else Bucket() for label in fresh}
        top_id = max([self.top_id, *(r["top_id"] for r in found.values())])
        version = Stored(self.spark, self.schema, self.keys, kept | new, self.bucket_rows, top_id)
        lines = [(label, b.path, b.n_rows, self.bucket_rows, top_id) for label, b in sorted(version.buckets.items())]
        self.spark.createDataFrame(lines, LIST).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/list")
        return version


def open_table(
    spark: SparkSession, folder: str | None, schema: T.StructType, keys: tuple[str, ...], buckets: int, bucket_rows: int = BUCKET_ROWS
) -> Stored:
    """The table in ``folder``, or an empty one of ``buckets`` buckets, a power of two, where there is none yet."""
    lines = []
    if folder is not None:
        try:
            lines = spark.read.schema(LIST).parquet(f"{folder}/list").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not lines:
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("buckets is a power of two")
        return Stored(spark, schema, keys, {buckets + k: Bucket() for k in range(buckets)}, bucket_rows, 0)
    return Stored(spark, schema, keys, {r["label"]: Bucket(r["path"], r["n_rows"]) for r in lines}, lines[0]["bucket_rows"], lines[0]["top_id"])
