"""How filters interact: what each removes, doubles or loses in every order of application.

Words are counted in a sparse document-term matrix. Tasks turn their documents into shards in
compressed-sparse-row form with words of their own; distinct words are numbered once for all
shards, and every shard is rewritten with these numbers. Row sums give words, numbers of entries
give distinct words. The other flags ride on the shards' rows, and rows are reduced to counts for
each part and combination of flags before any order is looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from repopulse.operators.numbering import PART, with_offsets
from repopulse.session import settle

FILTERS = "ABCDE"
#: A shard is closed once it holds so many bytes of text; one longer text is a shard of its own.
SHARD_BYTES = 64 << 20
#: Rows of a shard are cut into blocks of about so many entries; a longer row is a block of its own.
BLOCK_ENTRIES = 1 << 20
#: Words of several shards are numbered in runs of so many.
RUN = 1 << 18

#: A block of rows. ``words`` is the shard's vocabulary, on the shard's last block only.
BLOCK = pa.schema(
    [("shard", pa.int64()), ("words", pa.list_(pa.binary())), ("indptr", pa.binary()), ("indices", pa.binary()), ("data", pa.binary())]
)
#: Numbers of one shard's words in one run (shard, places, ids), or the words that the run saw first (shard null), from number first_id on.
NUMBERED = pa.schema(
    [("shard", pa.int64()), ("places", pa.binary()), ("ids", pa.binary()), ("words", pa.list_(pa.binary())), ("first_id", pa.int64()), ("n_new", pa.int64()), (PART, pa.int32())]
)


class _Block:
    """Rows of the matrix under way, in the shard's own word numbers."""

    def __init__(self) -> None:
        self.starts, self.indices, self.data, self.rows = [0], [], [], []

    def add(self, codes: np.ndarray) -> None:
        found, counts = np.unique(codes, return_counts=True)
        self.indices.append(found.astype("<u4"))
        self.data.append(counts.astype("<u4"))
        self.starts.append(self.starts[-1] + len(found))

    def batch(self, shard: int, words: list[bytes] | None, kept: list[str]) -> pa.RecordBatch:
        arrays = (np.asarray(self.starts, "<i8"), np.concatenate(self.indices), np.concatenate(self.data))
        fixed = pa.RecordBatch.from_arrays([pa.array([v], f.type) for f, v in zip(BLOCK, (shard, words, *(x.tobytes() for x in arrays)), strict=True)], schema=BLOCK)
        held = pa.Table.from_batches(self.rows).combine_chunks()
        lists = [pa.ListArray.from_arrays(pa.array([0, held.num_rows], pa.int32()), held.column(name).combine_chunks()) for name in kept]
        return pa.RecordBatch.from_arrays([*fixed.columns, *lists], names=[*BLOCK.names, *kept])


def _copied(batch: pa.RecordBatch, kept: list[str], begin: int, end: int) -> pa.RecordBatch:
    """Some rows of the kept columns, copied so that the batch with its texts can go."""
    places = pa.array(np.arange(begin, end))
    return pa.RecordBatch.from_arrays([batch.column(name).take(places) for name in kept], names=kept)


def _shards(kept: list[str], shard_bytes: int, block_entries: int):
    """A function over Arrow batches (text, kept columns) that yields the blocks of the task's shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, block = TaskContext.get().partitionId() << 32, 0, _Block()
        ids: defaultdict = defaultdict()
        ids.default_factory = ids.__len__
        for batch in batches:
            begun = 0
            for place, text in enumerate(batch.column(0)):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                block.add(np.fromiter(map(ids.__getitem__, words), np.uint32, len(words)))
                size += text.as_buffer().size if text.is_valid else 0
                full = size >= shard_bytes
                if full or block.starts[-1] >= block_entries:
                    block.rows.append(_copied(batch, kept, begun, place + 1))
                    yield block.batch(number, list(ids) if full else None, kept)
                    block, begun = _Block(), place + 1
                    if full:
                        number, size = number + 1, 0
                        ids.clear()
            if begun < batch.num_rows:
                block.rows.append(_copied(batch, kept, begun, batch.num_rows))
        if block.rows or ids:
            if not block.rows:
                block.add(np.zeros(0, np.uint32))
            yield block.batch(number, list(ids), kept)

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the sorted words of a partition from 0, in runs; the same word of another shard has the same number."""
    part, last, next_id = TaskContext.get().partitionId(), None, 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    fresh: list[bytes] = []

    def close() -> Iterator[pa.RecordBatch]:
        shards, places, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(shards, kind="stable")
        found, cuts = np.unique(shards[order], return_index=True)
        spans = zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True)
        rows = [(places[order[a:b]].astype("<u4").tobytes(), ids[order[a:b]].astype("<u8").tobytes()) for a, b in spans]
        columns = [[*found.tolist(), None], [*(r[0] for r in rows), None], [*(r[1] for r in rows), None]]
        columns += [[None] * len(rows) + [fresh], [next_id - len(fresh)] * (len(rows) + 1), [0] * len(rows) + [len(fresh)], [part] * (len(rows) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for f, v in zip(NUMBERED, columns, strict=True)], schema=NUMBERED)

    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("word").dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        again = int(words[0] == last)
        held.append((batch.column("shard").to_numpy(), batch.column("place").to_numpy(), codes + (next_id - again)))
        fresh += words[again:]
        next_id, last, n = next_id + len(words) - again, words[-1], n + batch.num_rows
        if n >= RUN:
            yield from close()
            held, fresh, n = [], [], 0
    if held:
        yield from close()


def document_terms(
    docs: DataFrame, text: str, kept: list[str], shard_bytes: int = SHARD_BYTES, block_entries: int = BLOCK_ENTRIES
) -> tuple[DataFrame, DataFrame]:
    """(dictionary, shards) of the sparse document-term matrix of whole texts; null texts are empty rows.

    dictionary: word (UTF-8), word_id, dense from 0 in no stated order. shards: blocks of rows with
    shard, indptr (64-bit), indices (64-bit word ids, in no order within a row), data (32-bit counts),
    all little-endian, and as lists with one entry for each row: the ``kept`` columns, n_words (row sum)
    and n_distinct (number of entries). Words are runs of characters other than blanks (space, tab to
    carriage return), case-sensitive.

    A shard sends each of its words to be numbered once, however many of its documents hold it, and
    gets their numbers back; a word of every document is one row for each shard. Words are sorted by
    Spark, and numbered as they stream past, so no task holds a vocabulary beyond one shard's.
    """
    chosen = docs.select(F.col(text).cast("binary").alias("_text"), *kept)
    held = [T.StructField(name, T.ArrayType(docs.schema[name].dataType)) for name in kept]
    local = settle(chosen.mapInArrow(_shards(kept, shard_bytes, block_entries), T.StructType([*from_arrow_schema(BLOCK).fields, *held])))
    words = local.select("shard", F.posexplode("words").alias("place", "word")).repartition("word").sortWithinPartitions("word")
    # Each shard has its words on one block. Rows of a few shards make a task, and so an Arrow batch, of the last step.
    dealt = max(1, local.where("words is not null").count())
    numbers = with_offsets(settle(words.mapInArrow(_number, from_arrow_schema(NUMBERED))), {"_offset": F.sum("n_new")})
    dictionary = numbers.where("shard is null").select(F.posexplode("words").alias("_place", "word"), (F.col("_offset") + F.col("first_id")).alias("_first"))
    dictionary = dictionary.select("word", (F.col("_first") + F.col("_place")).alias("word_id"))
    ids = numbers.where("shard is not null").repartition(dealt, "shard").groupBy("shard").agg(F.collect_list(F.struct("places", "ids", F.col("_offset").alias("offset"))).alias("_numbers"))
    margins = [T.StructField(name, T.ArrayType(T.LongType())) for name in ("n_words", "n_distinct")]
    final = T.StructType([*(f for f in local.schema.fields if f.name != "words"), *margins])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                starts, old, data = (
                    np.frombuffer(row.column(n)[0].as_buffer(), kind) for n, kind in (("indptr", "<i8"), ("indices", "<u4"), ("data", "<u4"))
                )
                new = np.zeros(int(old.max()) + 1 if len(old) else 0, "<i8")
                for part in row.column("_numbers")[0] or ():
                    places = np.frombuffer(part["places"].as_buffer(), "<u4")
                    seen = places < len(new)
                    new[places[seen]] = np.frombuffer(part["ids"].as_buffer(), "<i8")[seen] + part["offset"].as_py()
                sums = np.concatenate(([0], np.cumsum(data, dtype=np.int64)))
                changed = {
                    "indices": pa.array([new[old].tobytes()], pa.binary()),
                    "n_words": pa.array([np.diff(sums[starts])], pa.list_(pa.int64())),
                    "n_distinct": pa.array([np.diff(starts)], pa.list_(pa.int64())),
                }
                columns = [changed[n] if n in changed else row.column(n) for n in final.names]
                yield pa.RecordBatch.from_arrays(columns, names=final.names)

    return dictionary, local.drop("words").repartition(dealt, "shard").join(ids, "shard", "left").mapInArrow(rewrite, final)


def row_counts(shards: DataFrame, kept: list[str]) -> DataFrame:
    """One row for each row of the matrix: the ``kept`` columns, n_words and n_distinct."""
    return shards.select(F.inline(F.arrays_zip(*kept, "n_words", "n_distinct")))


def flag_counts(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Counts of documents by part and failed filters: part, mask (bit k for filter k), n, n_good, n_toxic.

    A: under 200 words. B: fewer than half as many distinct words as words. C: over 3% of the code
    points are A-Z. D: a character of ``#$%&*|``. E: the same text under a smaller doc_id. A row
    without doc_id neither fails E nor makes others fail, and has no label. A null text is empty,
    and so equal to other empty texts; a null lang is the empty part. A repeated row counts as often
    as it stands. Labels are those of the doc_id: good if any of its rows has quality 1, toxic likewise.

    Rows are first counted by doc_id and the text's digest, then by the digest, so that a text with
    very many copies is a row for each task in the second step and no task joins its copies.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    flagged = docs.select(
        F.col("text"),
        F.col("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (100 * upper.cast("bigint") > 3 * F.length(text).cast("bigint")).alias("c"),
        text.rlike(r"[#$%&*|]").alias("d"),
    )
    kept = ["doc_id", "part", "digest", "c", "d"]
    rows = row_counts(document_terms(flagged, "text", kept, shard_bytes)[1], kept)
    fails = {"A": F.col("n_words") < 200, "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"), "C": F.col("c"), "D": F.col("d")}
    bits = lambda on: sum((F.when(on[f], 1 << k).otherwise(0) for k, f in enumerate(FILTERS) if f in on), F.lit(0))
    each = rows.withColumn("mask", bits(fails)).groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    marked = each.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    # The rows with the smallest doc_id of a text do not fail E, nor do rows without one.
    same = ["digest", "mask", "part", "good", "toxic"]
    copies = marked.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("low"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))["n"].alias("n_low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_none"),
    )
    return _masks(copies)


def _masks(copies: DataFrame) -> DataFrame:
    """Settle filter E: of each digest, the rows of its least doc_id stay, the others fail."""
    lists = copies.groupBy("digest", "mask").agg(F.min("low").alias("least"), F.collect_list(F.struct("part", "good", "toxic", "n", "low", "n_low", "n_none")).alias("of"))
    each = lists.select("mask", "least", F.explode("of").alias("x")).select("mask", "least", "x.*")
    first = F.when(F.col("low") == F.col("least"), F.col("n_low")).otherwise(0) + F.col("n_none")
    split = F.array(F.struct(F.col("mask").alias("mask"), first.alias("n")), F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - first).alias("n")))
    counted = each.select("part", "good", "toxic", F.explode(split).alias("y"))
    return counted.groupBy("part", F.col("y.mask").alias("mask")).agg(
        F.sum("y.n").alias("n"), F.sum(F.col("y.n") * F.col("good")).alias("n_good"), F.sum(F.col("y.n") * F.col("toxic")).alias("n_toxic")
    )


def _steps(tables: DataFrame) -> DataFrame:
    """Every step of every order: filter_order, step, bit (the filter's) and before (the bits of those ahead of it)."""
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    number = lambda letter: F.instr(F.lit(FILTERS), letter) - 1
    steps = tables.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letters = F.split("filter_order", "")
    ahead = F.aggregate(F.slice(letters, F.lit(1), F.col("step") - 1), F.lit(0), lambda a, x: a + F.pow(F.lit(2), number(x)).cast("int"))
    return steps.withColumns({"bit": F.pow(F.lit(2), number(F.get(letters, F.col("step") - 1))).cast("int"), "before": ahead})


def audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each part, filter order and step: what the step keeps, removes, repeats and loses.

    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley;
    see :func:`flag_counts` for the filters and odd rows. An empty table gives no rows. shapley is the
    filter's removals summed over all orders: a document that fails f filters is first met by each of
    them in 120 / f orders.
    """
    counts = flag_counts(docs, labels, shard_bytes)
    tables = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "n_good", "n_toxic")).alias("of"))
    steps = _steps(tables)

    def total(wanted, value: str) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate("of", zero, lambda a, x: a + F.when(wanted(x["mask"]), x[value]).otherwise(zero))

    bit, before = F.col("bit"), F.col("before")
    has = lambda m: m.bitwiseAND(bit) != 0
    left = lambda m: m.bitwiseAND(before) == 0
    share = F.aggregate(
        "of",
        F.lit(0).cast("bigint"),
        lambda a, x: a + F.when(has(x["mask"]), (F.lit(120) / F.bit_count(x["mask"])).cast("bigint") * x["n"]).otherwise(0),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0, "n").alias("kept"),
        total(lambda m: has(m) & left(m), "n").alias("removed"),
        total(lambda m: has(m) & ~left(m), "n").alias("redundant"),
        total(lambda m: m == bit, "n").alias("unique_fails"),
        total(lambda m: has(m) & left(m), "n_good").alias("good_lost"),
        total(lambda m: has(m) & left(m), "n_toxic").alias("toxic_lost"),
        share.alias("shapley"),
    )
