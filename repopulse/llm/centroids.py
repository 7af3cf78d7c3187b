"""Centroid clustering in whole numbers, with dot products that are updated and never taken anew.

Every vector carries its exact dot product with every centroid. When centroids move, only the
components in which they changed are multiplied and added; distances follow from the products and
the squared norms. Products are written out with their vectors after each round, so a lost executor
repeats one round's part and rows never change places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.session import settle

#: Components of this size and beyond, after scaling, could carry a squared distance out of 64 bits.
TOO_LARGE = 1 << 27

Centroids = list[list[int]]


@dataclass(frozen=True)
class Clustering:
    """rows: vec_id, v (components), norm, dots (one for each centroid), cluster, distance. centroids: the last ones."""

    rows: DataFrame
    centroids: Centroids


def whole_vectors(vectors: DataFrame, dimensions: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and v, the components floor(scale * x), of vectors with all their components finite and none null.

    Vectors of another length, null vectors and such with a null, infinite or undefined component are
    left out. Components of 2^27 and beyond after scaling fail the job: distances would not be exact.
    """
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    kept = vectors.select("vec_id", x.alias("x")).where((F.size("x") == dimensions) & sound)
    fits = F.forall("x", lambda e: F.abs(e * scale) < TOO_LARGE)
    v = F.transform("x", lambda e: F.floor(e * scale).cast("int"))
    return kept.select("vec_id", F.when(fits, v).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int = 1) -> Centroids:
    """Vectors with the least SHA-256 of ``<seed>:<vec_id>``, at most ``k``; ties by components, null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in vectors.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()]


def _moved(rows: DataFrame, change: np.ndarray, norms: np.ndarray) -> DataFrame:
    """Rows with the changes of the centroids added to their products, and the nearest centroid taken again."""
    schema = "vec_id bigint, v array<int>, norm bigint, dots array<bigint>, cluster int, distance bigint"
    touched = np.flatnonzero(change.any(axis=0))
    narrow = np.ascontiguousarray(change[:, touched].T)
    k = len(norms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            dots = batch.column("dots").flatten().to_numpy(zero_copy_only=False).reshape(n, k)
            dots = dots + v[:, touched].astype(np.int64) @ narrow
            squared = norms[None, :] - 2 * dots
            cluster = squared.argmin(axis=1)
            norm = batch.column("norm").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("v"),
                    batch.column("norm"),
                    pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(dots.ravel(), pa.int64())),
                    pa.array(cluster, pa.int32()),
                    pa.array(norm + squared[np.arange(n), cluster], pa.int64()),
                ],
                names=["vec_id", "v", "norm", "dots", "cluster", "distance"],
            )

    return rows.select("vec_id", "v", "norm", "dots").mapInArrow(run, schema)


def _means(rows: DataFrame, centroids: Centroids) -> Centroids:
    """Centroids replaced by floor(sum / count) of their rows; one without rows stays. At most k rows reach the driver."""
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    found = list(centroids)
    for row in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        found[row.cluster] = [row[f"s{i}"] // row.n for i in range(len(centroids[0]))]
    return found


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, seed: int = 1) -> Clustering:
    """Cluster by ``rounds`` rounds of assignment and replacement, then assign once more.

    Ties go to the smaller number. With fewer than ``k`` vectors there are as many centroids as
    vectors; equal vectors may start several centroids, of which only the first gets rows. A repeated
    row counts as often as it stands; a null vec_id is kept. An empty table gives no rows.
    """
    whole = whole_vectors(vectors, dimensions, scale)
    norm = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, e: a + e.cast("bigint") * e)
    rows = settle(whole.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v", norm.alias("norm")))
    centroids = first_centroids(rows, k, seed)
    if not centroids:
        empty = rows.withColumns({"dots": F.array().cast("array<bigint>"), "cluster": F.lit(0), "distance": F.lit(0).cast("bigint")})
        return Clustering(empty, [])
    rows = rows.withColumn("dots", F.array_repeat(F.lit(0).cast("bigint"), len(centroids)))
    before = np.zeros((len(centroids), dimensions), np.int64)
    for last in range(rounds + 1):
        now = np.array(centroids, np.int64)
        rows = settle(_moved(rows, now - before, (now * now).sum(axis=1)))
        before = now
        if last < rounds:
            centroids = _means(rows, centroids)
    return Clustering(rows, centroids)


def report(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, and the digest of the vector's final centroid."""
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    spark = found.rows.sparkSession
    # One row for each centroid: k bounds the broadcast.
    named = F.broadcast(spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string"))
    sums = found.rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    sums = F.broadcast(sums.withColumn("inertia", inertia.scalar()).join(named, "cluster"))
    return found.rows.select("vec_id", "cluster", "distance").join(sums, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
