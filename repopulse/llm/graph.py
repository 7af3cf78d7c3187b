"""Connected components of an edge table, by Spark jobs only."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from repopulse.session import settle, small_side

#: Edges that a task can hold, and contracts at a time.
CHUNK = 100_000


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written out, and what tells them apart from others, seen while they were written."""
    seen = Observation()
    kept = settle(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")))
    return kept, (seen.get["n"], seen.get["s"])


def _contracted(edges: DataFrame, chunk: int) -> DataFrame:
    """Stars in place of the edges of each chunk that a task reads: the same components, fewer and shorter chains.

    The centre of a star is its smallest node. A task that reads ``chunk`` edges or fewer makes one forest of them.
    """

    def stars(parent: dict[str, str]) -> pa.RecordBatch:
        a, b = [], []
        for node in parent:
            root = node
            while parent[root] != root:
                root = parent[root]
            if root != node:
                a.append(node)
                b.append(root)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[str, str] = {}

        def find(node: str) -> str:
            while (above := parent.setdefault(node, node)) != node:
                parent[node] = node = parent[above]
            return node

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
            # As many edges as a chunk have twice as many nodes at most.
            if len(parent) > 2 * chunk:
                yield stars(parent)
                parent.clear()
        yield stars(parent)

    return edges.mapInArrow(run, "a string, b string")


def _lowest(edges: DataFrame) -> DataFrame:
    """(a, m): the smallest b of every a, settled, so that the join with the edges is by broadcast or can be split."""
    return small_side(edges.groupBy("a").agg(F.min("b").alias("m")), 200_000)


def components(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, root) for every node of an edge (a, b) but the roots; root is the smallest node of its component.

    Edges are contracted within the tasks that read them, and what is left within fewer tasks, one for
    each chunk of edges, as long as that halves their number; once they are a single chunk, they are done.
    Else each round ties the larger neighbours of every node to the smallest one, then the smaller ones
    likewise, until nothing changes; the number of rounds grows with the logarithm of the longest chain. Edges and grouped minima are written to the
    shared folder before they are joined. A node with very many neighbours is thus one row per task of
    the minima; its edges are joined by broadcast within the bound of ``small_side``, and beyond it by a
    join of two written tables, which Spark can split. Nodes and edges may repeat; nulls are no nodes.
    """
    larger_first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    found, before = _settled(_contracted(larger_first, chunk))
    held = None
    while before[0] and (held is None or 2 * before[0] <= held):
        held, tasks = before[0], math.ceil(before[0] / chunk)
        found, before = _settled(_contracted(found.coalesce(tasks), chunk))
        if tasks == 1:
            return found.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while before[0]:
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = settle(both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")))
        low = _lowest(larger)
        smaller = larger.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        found, now = _settled(smaller.unionByName(low.select("a", F.col("m").alias("b"))))
        if now == before:
            break
        before = now
    return found.select(F.col("a").alias("node"), F.col("b").alias("root"))


def with_roots(found: DataFrame) -> DataFrame:
    """The same with every root as a node of its own."""
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
