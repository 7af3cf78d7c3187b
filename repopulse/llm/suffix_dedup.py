"""Exact removal of long repeated byte strings with a logarithmic family of suffix arrays.

A string of ``width`` bytes is repeated if it starts at two places of the corpus; every byte of every
repeated string is removed. Strings do not cross documents.

The suffix arrays are sparse. Of every window of ``width`` bytes one suffix that starts in it is
kept, chosen by the content alone, so equal windows keep suffixes at equal places and a long match
cannot be missed; about one suffix in ninety bytes is enough. An array holds the hash of each
suffix's prefix and of the run of windows that it stands for, sorted, with counts. A new batch of
documents becomes an array of its own, is scanned against every existing level for suffixes that
both have, and joins the family as a level; levels of equal rank are merged, so there are never more
than the logarithm of the number of batches, and an entry is rewritten as often.

Scans find suffixes that occur twice. A run of windows that occurs twice as a whole is repeated. For
the rest, the strings around suffixes with several different runs are compared: first the part that
32 neighbouring windows share, then single windows where that part is repeated.

Equality is that of two 64-bit hashes throughout. Copies of a text share one key, and all tables are
joined on hashed keys and pre-aggregated, so a passage of very many documents is a count. What is
gathered for one text is bounded by its length. Null texts count as empty; texts shorter than
``width`` lose nothing. Ids may be null or repeat: every row is answered by its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.arrow_rows import pieces
from repopulse.llm.rolling import Rolling, anchors, window_hashes
from repopulse.session import settle, small_side

WIDTH = 400
PREFIX = 200
#: Neighbouring windows that are compared together first.
TOGETHER = 32


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole).alias("k1"),
        F.xxhash64(F.lit("second"), whole).alias("k2"),
        whole.cast("binary").alias("data"),
    )


def suffix_entries(keyed: DataFrame, width: int, prefix: int) -> DataFrame:
    """(k1, k2, start, count, place, suffix, run) for the kept suffixes of every text; place is the anchor's distance from start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [anchors(d.as_buffer(), width, prefix) for d in batch.column(2)]
            lengths = [len(f.start) for f in found]
            keys = [np.repeat(batch.column(k).to_numpy(), lengths) for k in (0, 1)]
            values = [np.concatenate([getattr(f, name) for f in found]) for name in ("start", "count", "place", "suffix", "run")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[0]),
                    pa.array(keys[1]),
                    pa.array(values[0], pa.int64()),
                    pa.array(values[1].astype(np.int32)),
                    pa.array(values[2].astype(np.int32)),
                    pa.array(values[3].view(np.int64)),
                    pa.array(values[4].view(np.int64)),
                ],
                ["k1", "k2", "start", "count", "place", "suffix", "run"],
            )

    return (
        keyed.where(F.length("data") >= width)
        .select("k1", "k2", "data")
        .mapInArrow(run, "k1 bigint, k2 bigint, start bigint, count int, place int, suffix bigint, run bigint")
    )


class SuffixFamily:
    """Sorted arrays of (suffix, run, n) in levels of rising rank."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        self._shared: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Index a batch of (suffix, run), after scanning it against itself and every level."""
        array = settle(batch.groupBy("suffix", "run").agg(F.count("*").alias("n")).sortWithinPartitions("suffix", "run"))
        self._shared.append(settle(array.groupBy("suffix").agg(F.sum("n").alias("n")).where("n > 1").select("suffix")))
        for _, level in self.levels:
            self._shared.append(settle(self.scan(array, level)))
        self.levels.append((0, array))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, one), (_, other) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, settle(self.merge(one, other))))

    @staticmethod
    def scan(array: DataFrame, level: DataFrame) -> DataFrame:
        """Suffixes that both arrays have."""
        return array.select("suffix").distinct().join(level.select("suffix").distinct(), "suffix")

    @staticmethod
    def merge(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.unionByName(other).groupBy("suffix", "run").agg(F.sum("n").alias("n")).sortWithinPartitions("suffix", "run")

    def shared(self) -> DataFrame:
        """(suffix, run, n, several) of the suffixes that occur twice or more; several: they have different runs."""
        suffixes, arrays = self._shared[0], self.levels[0][1]
        for frame in self._shared[1:]:
            suffixes = suffixes.unionByName(frame)
        for _, level in self.levels[1:]:
            arrays = arrays.unionByName(level)
        runs = arrays.join(suffixes.distinct(), "suffix", "left_semi").groupBy("suffix", "run").agg(F.sum("n").alias("n"))
        kinds = runs.groupBy("suffix").agg((F.count("*") > 1).alias("several"))
        return runs.join(kinds, "suffix")


def _contexts(hits: DataFrame, keyed: DataFrame, width: int) -> DataFrame:
    """(suffix, run, count, place, data): the bytes under the windows of each different run."""
    one = (
        hits.where("several")
        .groupBy("suffix", "run")
        .agg(F.min(F.struct("k1", "k2", "start", "count", "place")).alias("_at"))
        .select("suffix", "run", "_at.*")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("start", "count", "place", "suffix", "run")).alias("cuts"))
    )
    one = settle(one)
    wanted = keyed.join(small_side(one.select("k1", "k2")), ["k1", "k2"], "left_semi").join(one, ["k1", "k2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            out = []
            for data, cuts in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                whole = data.as_py()
                for cut in cuts:
                    end = cut["start"] + cut["count"] - 1 + width
                    out.append((cut["suffix"], cut["run"], cut["count"], cut["place"], whole[cut["start"] : end]))
            yield _batch(out, ["suffix", "run", "count", "place", "data"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()])

    cut = wanted.select("data", "cuts").mapInArrow(run, "suffix bigint, run bigint, count int, place int, data binary")
    # Copies of a text each give its runs.
    return settle(cut.dropDuplicates(["suffix", "run"]))


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _block_hashes(contexts: DataFrame, width: int) -> DataFrame:
    """(suffix, run, block, start, core, hull): hashes of a block of neighbouring windows.

    The core is what all windows of the block share, the hull is all that they cover; it is null where the
    run ends within the block. Blocks are counted from the anchor, so equal windows lie in equal blocks.
    """
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for suffix, key, count, place, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rolling = Rolling(np.frombuffer(data, np.uint8))
                blocks = np.arange(-place // TOGETHER, (count - 1 - place) // TOGETHER + 1)
                start = place + blocks * TOGETHER
                cores = rolling.some(start + TOGETHER - 1, np.full(len(start), width - TOGETHER + 1)).view(np.int64)
                inside = (start >= 0) & (start + TOGETHER <= count)
                hulls = np.zeros(len(start), np.int64)
                hulls[inside] = rolling.some(start[inside], np.full(int(inside.sum()), width + TOGETHER - 1)).view(np.int64)
                hulls = [h if i else None for h, i in zip(hulls.tolist(), inside.tolist(), strict=True)]
                out += [(suffix, key, *x) for x in zip(blocks.tolist(), start.tolist(), cores.tolist(), hulls, strict=True)]
            yield _batch(out, ["suffix", "run", "block", "start", "core", "hull"], kinds)

    return contexts.select("suffix", "run", "count", "place", "data").mapInArrow(
        run, "suffix bigint, run bigint, block int, start int, core bigint, hull bigint"
    )


def _repeated_windows(contexts: DataFrame, width: int) -> DataFrame:
    """(suffix, run, spans): the repeated windows of each run, as first and last distance from its start.

    Where the hull of a block occurs again, all its windows do; where the core does not, none does. What
    lies between, blocks at the ends of repeats, is compared window by window, with each other and with
    one block for each repeated hull of the same core.
    """
    hashed = settle(_block_hashes(contexts, width))
    cores = hashed.groupBy("suffix", "block", "core").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hulls = hashed.where("hull is not null").groupBy("suffix", "block", "hull").agg(F.count("*").alias("h")).where("h > 1")
    near = hashed.join(cores, ["suffix", "block", "core"], "left_semi").join(hulls, ["suffix", "block", "hull"], "left")
    near = settle(near.select("suffix", "run", "block", "start", "core", "hull", F.col("h").isNotNull().alias("whole")))
    full = near.where("whole").select("suffix", "run", F.struct(F.col("start").alias("first"), (F.col("start") + TOGETHER - 1).alias("last")).alias("s"))
    group = ["suffix", "block", "core"]
    ends = near.where("not whole")
    others = near.where("whole").groupBy(*group, "hull").agg(F.min("run").alias("run")).join(ends.select(*group).distinct(), group, "left_semi")
    wanted = ends.select("suffix", "run", "block").unionByName(others.select("suffix", "run", "block"))
    blocks = wanted.groupBy("suffix", "run").agg(F.collect_list("block").alias("blocks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            suffixes, keys, places, windows = [], [], [], []
            for suffix, key, count, place, data, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashed = window_hashes(data, width)
                at = (np.array(sorted(wanted))[:, None] * TOGETHER + place + np.arange(TOGETHER)).ravel()
                at = at[(at >= 0) & (at < count)]
                suffixes.append(np.full(len(at), suffix))
                keys.append(np.full(len(at), key))
                places.append(at)
                windows.append(hashed[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(suffixes)),
                    pa.array(np.concatenate(keys)),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    pa.array(np.concatenate(windows)),
                ],
                ["suffix", "run", "at", "window"],
            )

    windows = settle(
        contexts.join(blocks, ["suffix", "run"])
        .select("suffix", "run", "count", "place", "data", "blocks")
        .mapInArrow(run, "suffix bigint, run bigint, at int, window bigint")
    )
    twice = windows.groupBy("suffix", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    places = windows.join(twice, ["suffix", "window"], "left_semi").groupBy("suffix", "run").agg(F.sort_array(F.collect_list("at")).alias("at"))
    single = places.select("suffix", "run", F.explode(_spans(F.col("at"))).alias("s"))
    return full.unionByName(single).groupBy("suffix", "run").agg(F.collect_list("s").alias("spans"))


def _spans(at: Column) -> Column:
    """Runs of consecutive numbers in a sorted array."""
    first = F.filter(at, lambda x, k: (k == 0) | (F.get(at, F.greatest(k - 1, F.lit(0))) < x - 1))
    last = F.filter(at, lambda x, k: F.coalesce(F.get(at, k + 1) > x + 1, F.lit(True)))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, prefix: int = PREFIX, batches: int = 2
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row; kept holds the remaining bytes.

    The documents are indexed in ``batches``, by a hash of their text. Their number changes the work, not the result.
    """
    keyed = _keyed(docs, doc_id, text)
    entries = settle(suffix_entries(keyed, width, prefix).withColumn("batch", F.pmod("k1", F.lit(batches))))
    family = SuffixFamily()
    for number in range(batches):
        family.add(entries.where(F.col("batch") == number).select("suffix", "run"))
    shared = family.shared()
    hits = settle(entries.drop("batch").join(shared, ["suffix", "run"]))
    windows = _repeated_windows(_contexts(hits, keyed, width), width)
    whole = hits.where("n > 1").select("k1", "k2", "start", (F.col("start") + F.col("count") - 1).alias("last"))
    partly = (
        hits.where("n = 1 and several")
        .join(windows, ["suffix", "run"])
        .select("k1", "k2", "start", F.explode("spans").alias("_s"))
        .select("k1", "k2", (F.col("start") + F.col("_s.first")).alias("start"), (F.col("start") + F.col("_s.last")).alias("last"))
    )
    marks = settle(whole.unionByName(partly).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "last")).alias("marks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            sizes, removed, spans, kept, digests = [], [], [], [], []
            for data, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = data.as_py()
                cut = sorted((m["start"], m["last"] + width) for m in found or ())
                parts, end, lost, pieces_cut = [], 0, 0, 0
                for low, high in cut:
                    if low > end or not pieces_cut:
                        parts.append(data[end:low])
                        pieces_cut += 1
                        lost += high - low
                    elif high > end:
                        lost += high - end
                    end = max(end, high)
                parts.append(data[end:])
                rest = b"".join(parts)
                sizes.append(len(data))
                removed.append(lost)
                spans.append(pieces_cut)
                kept.append(rest)
                digests.append(hashlib.sha256(rest).hexdigest())
            numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
    return keyed.join(marks, ["k1", "k2"], "left").select("doc_id", "data", "marks").mapInArrow(run, schema)
