"""Near-duplicate classes by a chosen-path join on five-word shingles.

1. Every text becomes its set of shingles. Texts with equal sets are copies: one set stands for them.
2. Chosen paths. In each of several runs a set samples a few of its tokens, two on average at a
   threshold of 0.8, and enters one bucket per token; the sampling hash is shared, so similar sets meet. Small
   buckets are compared in full, on short sketches, and give a spanning forest of the pairs that may
   be similar. A bucket that is too large (a passage that very many texts share) is compared in
   blocks. If that joined most of its members, the others are compared with those and go on as a
   bucket; else it is split again on tokens sampled under its own path. Once what is still large has
   few pairs for the number of sets, or after the last level, it is compared block by block.
3. Candidate components are made from the forests. Within them all pairs are compared exactly, in
   blocks, which gives each set's number of links and the links that form the final classes.

Two sets at the threshold draw 1.6 tokens in common on average, whatever the threshold (``plan_of``).
They miss one bucket level with probability 0.2 at most and a whole run of any depth with 0.36; runs
are repeated until a pair is found with the target recall, ten times for a miss in under 4 in 100,000.
A class is only missed if this happens to all pairs that would connect it. Nothing is capped: no
bucket, partner or component is cut short.

Groups are compared in tasks of bounded size, pairs are never emitted, and copies never expanded.
Texts of one to four words are one shingle. Null and wordless texts are not similar to anything:
each is a class of its own. Ids may be null or repeat; copies of a row are members of one class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from repopulse.llm.arrow_rows import pieces, runs
from repopulse.llm.graph import components, with_roots
from repopulse.session import settle, small_side

WORD = re.compile(r"\w+")
SHINGLE = 5
#: Tokens that two sets at the threshold draw in common in each run and level, on average.
IN_COMMON = 1.6
#: Chance that such a pair is found in some run.
RECALL = 0.99996
#: Sets whose sketches, and whose tokens, are compared with each other at a time.
BLOCK = 2048
EXACT_BLOCK = 512
LEVELS = 6
#: Blocks of sketches that each set is compared with, on average, before large buckets are split instead.
AT_ONCE = 2
#: From here on, sketches are compared bin by bin.
WIDE = 256
#: The side of members that are compared within their own block.
WITHIN = 2
#: Sketch bins, and the estimate from which a pair is a candidate: five deviations below the threshold of 0.8.
BINS = 128
MARGIN = 0.2

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Plan(NamedTuple):
    """Tokens that a set samples on average in each run and level, and the number of runs."""

    drawn: float
    runs: int


def plan_of(threshold_percent: int, recall: float = RECALL) -> Plan:
    """What a threshold and a target recall ask for.

    Of two sets at Jaccard similarity t the larger one shares a part t of its tokens at least, so sets that draw
    IN_COMMON / t tokens have IN_COMMON in common. A run loses a pair if the chain of shared buckets dies out: the
    smallest root of q = exp(-IN_COMMON * (1 - q)). Runs are independent, so q ** runs is what all of them lose.
    """
    if not 0 < threshold_percent <= 100 or not 0 < recall < 1:
        raise ValueError("the threshold is above 0 and at most 100 percent, the recall strictly between 0 and 1")
    lost = 0.0
    for _ in range(200):
        lost = math.exp(-IN_COMMON * (1 - lost))
    return Plan(100 * IN_COMMON / threshold_percent, math.ceil(math.log(1 - recall) / math.log(lost)))



def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += hashed[k : len(words) - width + 1 + k] * _MULTIPLIERS[k]
    return np.unique(_mix(total))


def sketch_of(tokens: np.ndarray) -> bytes:
    """A byte for each bin of the hash range, from its smallest token; 0 for an empty bin."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 7)
    at = np.searchsorted(tokens, edges)
    first = tokens[np.minimum(at, len(tokens) - 1)]
    filled = (at < len(tokens)) & (first >> np.uint64(64 - 7) == np.arange(BINS, dtype=np.uint64))
    return np.where(filled, 1 + _mix(first) % np.uint64(255), 0).astype(np.uint8).tobytes()


def _limit(drawn: float, n: int) -> np.uint64:
    """The hash up to which a token of a set of n is drawn."""
    return np.uint64(min(min(1.0, drawn / n) * 2.0**64, 2.0**64 - 4096))


def sampled(tokens: np.ndarray, path: np.uint64, plan: Plan) -> np.ndarray:
    """Buckets of a set below ``path``: one for each token whose hash under the path is small for the set's size."""
    drawn = _mix(tokens ^ path)
    return _mix(drawn[drawn <= _limit(plan.drawn, len(tokens))] + path)


def root_buckets(tokens: np.ndarray, plan: Plan) -> np.ndarray:
    """Buckets of all runs. The tokens are hashes already, so a multiplication draws anew for each run."""
    limit = _limit(plan.drawn, len(tokens))
    found = []
    for run, factor in enumerate(_mix(np.arange(1, plan.runs + 1, dtype=np.uint64)) | np.uint64(1)):
        drawn = tokens * factor
        found.append(_mix(drawn[drawn <= limit] + np.uint64(run)))
    return np.concatenate(found)


SETS = "doc_id bigint, text_key bigint, set_key string, n int, sketch binary, buckets array<bigint>"


def shingle_sets(docs: DataFrame, plan: Plan) -> DataFrame:
    """The set of every document of (doc_id, text): its key, size, sketch and buckets; n is 0 without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys, sizes, sketches, buckets = [], [], [], []
            for text in batch.column(2).to_pylist():
                tokens = shingle_set(text)
                keys.append(xxhash.xxh3_128_hexdigest(tokens.tobytes()))
                sizes.append(len(tokens))
                sketches.append(sketch_of(tokens) if len(tokens) else b"")
                buckets.append(root_buckets(tokens, plan).view(np.int64) if len(tokens) else [])
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(keys, pa.string()),
                pa.array(sizes, pa.int32()),
                pa.array(sketches, pa.binary()),
                pa.array(buckets, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "set_key", "n", "sketch", "buckets"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return source.mapInArrow(run, SETS)


def _forest(alike: np.ndarray) -> np.ndarray:
    """For each row of a symmetric relation, the smallest row that chains of related rows lead to."""
    n = len(alike)
    root = np.arange(n)
    seen = np.zeros(n, bool)
    for start in range(n):
        if seen[start]:
            continue
        front = np.zeros(n, bool)
        front[start] = True
        while front.any():
            seen |= front
            root[front] = start
            front = alike[front].any(axis=0) & ~seen
    return root


def _alike(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of a left and a right sketch may reach the threshold."""
    empty = (left == 0).astype(np.float32) @ (right == 0).astype(np.float32).T
    out = np.zeros((len(left), len(right)), bool)
    bins = np.ascontiguousarray(right.T)
    for low in range(0, len(left), 32):
        part, both = left[low : low + 32], empty[low : low + 32]
        if len(right) < WIDE:
            same = (part[:, None, :] == right[None, :, :]).sum(axis=2)
        else:
            same = np.zeros((len(part), len(right)), np.uint8)
            for k in range(BINS):
                same += part[:, k, None] == bins[k]
        # Bins that both fill alike, of those that one of both fills.
        out[low : low + 32] = same - both >= (threshold - MARGIN) * (BINS - both)
    return out


EDGES = "bucket bigint, a string, b string"


def _edges(found: list[tuple[int, str, str]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "a", "b"])


def _link_groups(members: DataFrame, threshold: float) -> DataFrame:
    """(bucket, a, b): forests of candidate pairs within the groups of (bucket, place, side, set_key, sketch).

    A group is one block, or two blocks with sides 0 and 1 of which only pairs across are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, str, str]] = []
        for group in runs(batches, "place"):
            if group.num_rows < 2:
                continue
            keys = group.column("set_key").to_pylist()
            sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(keys), BINS)
            side = group.column("side").to_numpy()
            if side[0] == WITHIN:
                alike = _alike(sketches, sketches, threshold)
            else:
                alike = np.zeros((len(keys), len(keys)), bool)
                across = np.ix_(side == 0, side == 1)
                alike[across] = _alike(sketches[side == 0], sketches[side == 1], threshold)
                alike |= alike.T
            bucket = group.column("bucket")[0].as_py()
            out += [(bucket, keys[i], keys[r]) for i, r in enumerate(_forest(alike).tolist()) if i != r]
            if len(out) > 5000:
                yield _edges(out)
                out = []
        yield _edges(out)

    placed = members.repartition("place").sortWithinPartitions("place")
    return placed.select("bucket", "place", "side", "set_key", "sketch").mapInArrow(run, EDGES)


def _blocks(size: Column, most: int) -> Column:
    return F.ceil(size / F.lit(most)).cast("int")


def _block_of(size: Column, most: int) -> Column:
    """A member's block; each bucket deals its members differently."""
    return F.pmod(F.xxhash64("set_key", "bucket"), _blocks(size, most)).cast("int")


def _block_pairs(members: DataFrame, most: int) -> DataFrame:
    """(place, side, ...) for every pair of blocks of a bucket of (bucket, size, set_key, ...)."""
    return (
        members.withColumn("_block", _block_of(F.col("size"), most))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), _blocks(F.col("size"), most) - 1)))
        .withColumn("place", F.xxhash64("bucket", F.least("_block", "_other"), F.greatest("_block", "_other")))
        .withColumn("side", F.when(F.col("_block") < F.col("_other"), 0).when(F.col("_block") > F.col("_other"), 1).otherwise(WITHIN))
        .drop("_block", "_other")
    )


def _across(members: DataFrame, most: int) -> DataFrame:
    """(place, side, ...) for blocks of outsiders with blocks of the main group of (bucket, size, main, outside, set_key, ...)."""
    main = F.col("size") - F.col("outside_size")
    own = F.when(F.col("outside"), _block_of(F.col("outside_size"), most)).otherwise(_block_of(main, most))
    others = F.when(F.col("outside"), _blocks(main, most)).otherwise(_blocks(F.col("outside_size"), most))
    return (
        members.withColumns({"_own": own, "_other": F.explode(F.sequence(F.lit(0), others - 1)), "side": F.when(F.col("outside"), 0).otherwise(1)})
        .withColumn("_first", F.when(F.col("outside"), F.col("_own")).otherwise(F.col("_other")))
        .withColumn("_second", F.when(F.col("outside"), F.col("_other")).otherwise(F.col("_own")))
        .withColumn("place", F.xxhash64(F.lit("across"), "bucket", "_first", "_second"))
        .drop("_own", "_other", "_first", "_second")
    )


def _unfinished(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Large buckets whose members are not one component: (bucket, size, set_key, outside, outside_size).

    outside tells the members that are not in the bucket's largest component.
    """
    labelled = large.join(roots, F.col("set_key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_key"))
    main = (
        labelled.groupBy("bucket", "size", "root")
        .agg(F.count("*").alias("_n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("_n", "root")).alias("_main"), F.first("size").alias("_size"))
        .where(F.col("_main._n") < F.col("_size"))
        .select("bucket", F.col("_main.root").alias("_main"), F.col("_main._n").alias("_n"))
    )
    return labelled.join(small_side(main), "bucket").select(
        "bucket", "size", "set_key", (F.col("root") != F.col("_main")).alias("outside"), (F.col("size") - F.col("_n")).alias("outside_size")
    )


def _split(unfinished: DataFrame, texts: Callable[[DataFrame], DataFrame], plan: Plan) -> DataFrame:
    """(bucket, set_key) one level below the buckets of (bucket, set_key)."""
    of_set = unfinished.groupBy("set_key").agg(F.collect_set("bucket").alias("buckets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, keys = [], []
            for key, text, buckets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = shingle_set(text)
                if xxhash.xxh3_128_hexdigest(tokens.tobytes()) != key:
                    continue
                for bucket in buckets:
                    below = sampled(tokens, np.int64(bucket).astype(np.uint64), plan).view(np.int64).tolist()
                    found += below
                    keys += [key] * len(below)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(found, pa.int64()), "set_key": pa.array(keys, pa.string())})

    return texts(of_set).select("set_key", "text", "buckets").mapInArrow(run, "bucket bigint, set_key string").distinct()


def candidate_components(sets: DataFrame, texts: Callable[[DataFrame], DataFrame], threshold: float, plan: Plan) -> DataFrame:
    """(node, root), without the roots themselves, of the pairs that may be similar. ``texts`` adds a text to a frame of set keys.

    Buckets larger than a block are split, level by level, until all pairs of their members are no more than AT_ONCE blocks
    for each set of the table; then, or on the last level, they are compared in full, block by block.

    Counts of buckets are written before entries are joined to them: a bucket that a third of all sets
    share is joined by broadcast, or by a join of two written tables that Spark can split.
    """
    sketches = sets.select("set_key", "sketch")
    entries = sets.select("set_key", F.explode("buckets").alias("bucket"))
    edges = None
    for level in range(LEVELS + 1):
        sizes = small_side(entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), 500_000)
        shared = settle(entries.join(sizes, "bucket").select("bucket", "size", "set_key"))
        # Members of a large bucket are dealt into blocks.
        dealt = shared.withColumns({"place": F.xxhash64("bucket", _block_of(F.col("size"), BLOCK)), "side": F.lit(WITHIN)})
        found = settle(_link_groups(dealt.join(sketches, "set_key"), threshold))
        new = found.select("a", "b")
        edges = new if edges is None else edges.unionByName(new)
        large = sizes.where(F.col("size") > BLOCK)
        if large.isEmpty():
            return components(edges)
        tied = found.join(large, "bucket").groupBy("bucket", "size").agg(F.count("*").alias("tied"))
        tied = small_side(tied.where(F.col("tied") * 2 >= F.col("size")).select("bucket", "size"))
        large = shared.where(F.col("size") > BLOCK)
        # Where hardly anything was joined, the bucket is split. Else one component may have most of it already.
        open_members = large.join(tied, "bucket", "left_anti").select("bucket", "size", "set_key")
        main = None
        if not tied.isEmpty():
            roots = components(edges)
            edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            unfinished = settle(_unfinished(large.join(tied.select("bucket"), "bucket"), roots))
            one_main = F.col("outside_size") * 2 <= F.col("size")
            open_members = open_members.unionByName(unfinished.where(~one_main).select("bucket", "size", "set_key"))
            main = unfinished.where(one_main)
            main = None if main.isEmpty() else main
        # The others are compared with the main component, and stay together as a bucket.
        left = open_members.withColumn("known", F.lit(True))
        if main is not None:
            outside = main.where("outside").select(F.xxhash64(F.lit("outside"), "bucket").alias("bucket"), F.col("outside_size").alias("size"), "set_key")
            left = left.unionByName(outside.withColumn("known", F.lit(False)))
        seen = Observation()
        left = settle(left.observe(seen, F.sum("size").alias("pairs")))
        if main is None and not seen.get["pairs"]:
            return components(edges)
        last = level == LEVELS or (seen.get["pairs"] or 0) <= AT_ONCE * BLOCK * sets.count()
        wanted = ["bucket", "place", "side", "set_key", "sketch"]
        groups = [] if main is None else [_across(main.join(sketches, "set_key"), BLOCK).select(wanted)]
        if last:
            # The blocks of a bucket of this level are known within themselves.
            pairs = _block_pairs(left.join(sketches, "set_key"), BLOCK)
            groups.append(pairs.where((F.col("side") != WITHIN) | ~F.col("known")).select(wanted))
        if groups:
            across = _link_groups(reduce(DataFrame.unionByName, groups), threshold)
            edges = edges.unionByName((across if last else settle(across)).select("a", "b"))
        if last:
            return components(edges)
        entries = _split(left.where("known").select("bucket", "set_key"), texts, plan)
        entries = settle(entries.unionByName(left.where("not known").select("bucket", "set_key")))


def _exact_groups(members: DataFrame, threshold_percent: int) -> DataFrame:
    """Links within the groups of (place, side, whole, set_key, tokens): a count for each set, and a forest of links."""

    def overlaps(arrays: list[np.ndarray]) -> np.ndarray:
        n = len(arrays)
        row = np.repeat(np.arange(n), [len(a) for a in arrays])
        _, column, uses = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        keep = uses[column] > 1
        number = np.cumsum(uses > 1) - 1
        row, column = row[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        total, width = np.zeros((n, n), np.float32), 4096
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            part = slice(*np.searchsorted(column, [low, low + width]))
            dense = np.zeros((n, width), np.float32)
            dense[row[part], column[part] - low] = 1
            total += dense @ dense.T
        return total.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, links, whole = [], [], [], []
        for group in runs(batches, "place"):
            keys = group.column("set_key").to_pylist()
            arrays = [x.values.to_numpy() for x in group.column("tokens")]
            sizes = np.array([len(x) for x in arrays])
            shared = overlaps(arrays)
            alike = 100 * shared >= threshold_percent * (sizes[:, None] + sizes[None, :] - shared)
            np.fill_diagonal(alike, False)
            side = group.column("side").to_numpy()
            if side[0] != WITHIN:
                alike &= side[:, None] != side[None, :]
            root = _forest(alike)
            a += keys
            b += [keys[r] for r in root.tolist()]
            links += alike.sum(axis=1).tolist()
            whole += group.column("whole").to_pylist()
            if len(a) > 5000:
                yield batch_of(a, b, links, whole)
                a, b, links, whole = [], [], [], []
        yield batch_of(a, b, links, whole)

    def batch_of(a: list[str], b: list[str], links: list[int], whole: list[bool]) -> pa.RecordBatch:
        columns = [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(links, pa.int64()), pa.array(whole, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "links", "whole"])

    placed = members.withColumn("whole", F.col("size") <= EXACT_BLOCK).repartition("place").sortWithinPartitions("place")
    return placed.select("place", "side", "whole", "set_key", "tokens").mapInArrow(run, "a string, b string, links bigint, whole boolean")


def _with_tokens(frame: DataFrame) -> DataFrame:
    """(bucket, size, set_key, text) with the shingles in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            tokens = [shingle_set(t) for t in batch.column(3).to_pylist()]
            right = [xxhash.xxh3_128_hexdigest(t.tobytes()) == k for t, k in zip(tokens, batch.column(2).to_pylist(), strict=True)]
            columns = [*batch.columns[:3], pa.array([t.view(np.int64) for t in tokens], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "size", "set_key", "tokens"]).filter(pa.array(right))

    return frame.select("bucket", "size", "set_key", "text").mapInArrow(
        run, "bucket string, size bigint, set_key string, tokens array<bigint>"
    )


def near_duplicates(docs: DataFrame, threshold_percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, root, class_id, n_links, n_copies) for every document.

    root names the class, null without words; class_id is the smallest doc_id of the class; n_links counts the other sets at or above the
    threshold, n_copies the documents with the same set. text_key is a hash of the text.
    """
    plan = plan_of(threshold_percent)
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    every = settle(shingle_sets(plain, plan))
    worded = every.where("n > 0")
    # One document for each set; the rest of its row follows from the set.
    sets = settle(
        worded.groupBy("set_key").agg(
            F.count("*").alias("n_copies"),
            F.min(F.struct("doc_id", "text_key")).alias("_one"),
            F.first("sketch").alias("sketch"),
            F.first("buckets").alias("buckets"),
        )
    )
    ids = sets.select("set_key", F.col("_one.doc_id").alias("_id"), F.col("_one.text_key").alias("_tk"))
    source = plain.select(F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_tk"), "text")
    if _repeats(every):
        source = source.dropDuplicates(["_id", "_tk"])

    def texts(keys: DataFrame) -> DataFrame:
        """A frame with set_key, and the text of the document that stands for the set."""
        wanted = small_side(keys.join(ids, "set_key"), 200_000)
        both = source.alias("s").join(wanted.alias("w"), F.expr("s._id <=> w._id and s._tk = w._tk"))
        return both.select("w.*", "s.text")

    candidates = with_roots(candidate_components(sets, texts, threshold_percent / 100, plan))
    sizes = small_side(candidates.groupBy("root").agg(F.count("*").alias("size")), 500_000)
    members = settle(candidates.join(sizes, "root").select(F.col("root").alias("bucket"), "size", F.col("node").alias("set_key")))
    checked = settle(_exact_groups(_block_pairs(_with_tokens(texts(members)), EXACT_BLOCK), threshold_percent))
    links = checked.groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("n_links"))
    # A component of one block has its classes already; the links of several blocks are put together.
    single = checked.where("whole and a != b").select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = single.unionByName(components(checked.where("not whole").select("a", "b")))
    roots = settle(roots)
    joined = (
        sets.select("set_key", "n_copies", F.col("_one.doc_id").alias("_least"))
        .join(links, "set_key", "left")
        .join(with_roots(roots).withColumnRenamed("node", "set_key"), "set_key", "left")
    )
    joined = settle(joined)
    # Classes of several sets; the others are their own. What is joined is written out, so that Spark can split a hot class or set.
    least = small_side(joined.where("root is not null").groupBy("root").agg(F.min("_least").alias("_class")), 500_000)
    known = joined.join(least, "root", "left")
    of_set = settle(
        known.select("set_key", "n_copies", "n_links", F.coalesce("root", "set_key").alias("root"), F.coalesce("_class", "_least").alias("class_id"))
    )
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return (
        worded.select("doc_id", "text_key", "set_key")
        .join(of_set, "set_key")
        .select("doc_id", "text_key", "root", "class_id", F.coalesce("n_links", zero).alias("n_links"), "n_copies")
        .unionByName(
            every.where("n = 0").select(
                "doc_id",
                "text_key",
                F.lit(None).cast("string").alias("root"),
                F.col("doc_id").alias("class_id"),
                zero.alias("n_links"),
                one.alias("n_copies"),
            )
        )
    )


def _repeats(rows: DataFrame) -> bool:
    """Whether a document has several rows."""
    return not rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def keep_one(docs: DataFrame, threshold_percent: int = 80) -> DataFrame:
    """One document of each class, that with the smallest doc_id and then text_key, with all its columns.

    Wordless documents stay; repeated rows of one document count once.
    """
    found = settle(near_duplicates(docs, threshold_percent))
    best = found.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("_k")).select("_k.*")
    kept = settle(best.unionByName(found.where("root is null").select("doc_id", "text_key").distinct()))
    out = (
        docs.withColumn("_tk", F.xxhash64("text"))
        .alias("d")
        .join(kept.alias("k"), F.expr("d.doc_id <=> k.doc_id and d._tk = k.text_key"), "left_semi")
    )
    return (out.dropDuplicates(["doc_id", "_tk"]) if _repeats(found) else out).drop("_tk")
