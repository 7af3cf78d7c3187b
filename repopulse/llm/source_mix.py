"""A mix of sources by target weights, from a low-discrepancy schedule of equal blocks of words.

Targets share the corpus by weight, with a bound on how often a source may repeat. The line of all
words to take is cut into slots of equal length, a power of two of them, and each source holds one
interval of that line: its cumulative target. Slots are served in van der Corput order, the reversed
bits of their place on the line, so that every stretch of the mix holds its sources in proportion.
A source's slots are ranked, and the block of that rank of its shuffled words fills the slot; a slot
that several sources share is filled by a piece of each. Column expressions and joins only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.operators.numbering import numbered, running_totals
from repopulse.session import settle, small_side

WEIGHTS = (5, 2, 1)
#: Words a slot holds at most; all slots but the last ones of the line hold the same number.
BLOCK_WORDS = 1024
#: Slots of one source are generated in groups of so many neighbours on the line.
NEIGHBOURS = 4096


@dataclass(frozen=True)
class Mix:
    """documents: doc_id, size, source_no, start (place in the source's shuffled words, null if size is 0).
    sources: source_no, source, weight, source_size, target, words (whole words to take).
    schedule: slot, source_no, start, n: the words that the slot takes of the source, repeated end to end.
    pieces: slot, source_no, start (of the document), pass, n: the mix itself, by documents.
    """

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame
    pieces: DataFrame


def _scalar(df: DataFrame, *columns: Column) -> tuple[int, ...]:
    return tuple(x or 0 for x in df.agg(*columns).first())


def _big(value: int | Column) -> Column:
    """A whole number of up to 38 digits, so that products of words and weights stay exact."""
    return (F.lit(value) if isinstance(value, int) else value).cast("decimal(19,0)")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3) -> DataFrame:
    """source_no, source, weight, source_size, target and words of sources (source, source_size).

    Sources in code point order, null last, get the weights in turn. All words are shared by weight; a
    target above ``most_repeats`` times its source's size stops there, and the excess is shared again
    among the others until none is above. Each round is one aggregate over the sources. words is the
    target rounded so that running totals are the rounded running totals of targets: never above the
    stop, and all of them together give all words.
    """
    order = F.col("source").asc_nulls_last()
    turn = F.array(*map(F.lit, weights))
    ranked = numbered(sizes, "source_no", order).withColumns(
        {"weight": F.get(turn, (F.col("source_no") % len(weights)).cast("int")).cast("bigint"), "stop": most_repeats * F.col("source_size")}
    )
    ranked = settle(ranked)
    everything, total_weight = _scalar(ranked, F.sum("source_size"), F.sum("weight"))
    stopped, free = 0, total_weight
    while True:
        over = _big(F.col("stop")) * _big(free) < _big(everything - stopped) * _big(F.col("weight"))
        found = _scalar(ranked, F.sum(F.when(over, F.col("stop"))), F.sum(F.when(~over, F.col("weight"))))
        if found == (stopped, free):
            break
        stopped, free = found
    left, free = everything - stopped, max(free, 1)
    parts = {"_fixed": F.when(over, F.col("stop")).otherwise(0), "_free": F.when(over, 0).otherwise(F.col("weight"))}
    run = running_totals(ranked.withColumns(parts), {"_fixed_before": F.col("_fixed"), "_free_before": F.col("_free")}, order)
    place = lambda fixed, weight: fixed + F.call_function("div", _big(weight) * _big(left), _big(free))
    upper = place(F.col("_fixed_before") + F.col("_fixed"), F.col("_free_before") + F.col("_free"))
    lower = place(F.col("_fixed_before"), F.col("_free_before"))
    shared = (left * F.col("weight")).cast("double") / F.lit(free).cast("double")
    return run.select(
        "source_no",
        "source",
        "weight",
        "source_size",
        F.when(over, F.col("stop").cast("double")).otherwise(shared).alias("target"),
        lower.alias("lower"),
        (upper - lower).alias("words"),
    )


def _within(df: DataFrame, bucket: Column, value: Column, name: str, *order: str) -> DataFrame:
    """Add the sum of ``value`` over earlier rows of the same source, in the order of bucket and ``order``.

    Buckets are summed first, so that a source with a third of all rows is many groups and no task
    orders more than one bucket of it.
    """
    rows = df.withColumns({"_bucket": bucket, "_value": value})
    earlier = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("source_no", "_bucket").agg(F.sum("_value").alias("_total"))
    before = F.coalesce(F.sum("_total").over(earlier("source_no").orderBy("_bucket")), F.lit(0))
    starts = totals.select("source_no", "_bucket", before.alias("_before"))
    inside = F.coalesce(F.sum("_value").over(earlier("source_no", "_bucket").orderBy(*order)), F.lit(0))
    placed = rows.withColumn("_inside", inside).join(starts, ["source_no", "_bucket"])
    return placed.withColumn(name, F.col("_before") + F.col("_inside")).drop("_bucket", "_value", "_before", "_inside")


def _schedule(sources: DataFrame, block: int, bits: int) -> DataFrame:
    """slot, source_no, start, n: every source's interval of the line cut at the slots' bounds.

    Whole slots of a source take its blocks in the order in which they are served. The ends of the
    interval, which fill slots in part, take what follows the last whole block.
    """
    lower, upper = F.col("lower"), F.col("lower") + F.col("words")
    first, last = F.floor(lower / block), F.floor((upper - 1) / block)
    groups = F.sequence(F.floor(first / NEIGHBOURS), F.floor(last / NEIGHBOURS))
    groups = sources.where("words > 0").select("source_no", lower.alias("lower"), upper.alias("upper"), F.explode(groups).alias("_group"))
    groups = groups.repartition("source_no", "_group")
    first, last = F.floor(F.col("lower") / block), F.floor((F.col("upper") - 1) / block)
    span = F.sequence(F.greatest(first, F.col("_group") * NEIGHBOURS), F.least(last, F.col("_group") * NEIGHBOURS + (NEIGHBOURS - 1)))
    cells = groups.select("source_no", "lower", "upper", F.explode(span).alias("_cell"))
    begin, end = F.greatest("lower", F.col("_cell") * block), F.least("upper", (F.col("_cell") + 1) * block)
    reversed_bits = F.conv(F.reverse(F.lpad(F.bin("_cell"), bits, "0")), 2, 10).cast("bigint") if bits else F.lit(0).cast("bigint")
    cells = cells.select("source_no", "lower", "upper", "_cell", reversed_bits.alias("slot"), (end - begin).alias("n"))
    whole = F.when(F.col("n") == block, 1).otherwise(0)
    ranked = _within(cells, F.shiftright("slot", bits // 2), whole, "_rank", "slot")
    n_whole = F.greatest(F.floor(F.col("upper") / block) - F.ceil(F.col("lower") / block), F.lit(0))
    # Of two parts the one at the lower end comes first; its length is what the other starts behind.
    at_lower = F.col("_cell") * block <= F.col("lower")
    behind = F.when(at_lower, 0).otherwise(F.pmod(-F.col("lower"), F.lit(block)))
    start = F.when(F.col("n") == block, F.col("_rank") * block).otherwise(n_whole * block + behind)
    return ranked.select("slot", "source_no", start.cast("bigint").alias("start"), "n")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = 3,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
) -> Mix:
    """Mix documents (doc_id, source and text) by source.

    size: words of the whole text, 0 for a null one. Documents are shuffled by the SHA-256 of their id
    and text, so reruns agree; a null id or source is a value like any other, and a repeated row is
    another document. A source of no words takes part with target 0. No document is taken more often
    than ``most_repeats`` times, and each source gives its target to the word. An empty table gives
    empty frames. Other columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    shuffled = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), whole), 256)
    sized = settle(
        docs.select("doc_id", "source", F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"), shuffled.alias("_order"))
    )
    sources = settle(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_repeats))
    everything, = _scalar(sources, F.sum("source_size"))
    bits = 0
    while everything > block_words << bits:
        bits += 1
    block = max(1, -(-everything // (1 << bits)))
    schedule = settle(_schedule(sources, block, bits))
    wanted = small_side(sources.select("source", "source_no", "source_size", "words"))
    n_docs, = _scalar(sized, F.count(F.lit(1)))
    depth = max(1, n_docs.bit_length() // 2)
    named = sized.join(wanted, sized["source"].eqNullSafe(wanted["source"])).select("doc_id", "size", "_order", "source_no", "source_size", "words")
    bucket = F.shiftright(F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint"), 32 - min(depth, 32))
    placed = _within(named.where("size > 0"), bucket, F.col("size"), "start", "_order", "size")
    placed = settle(placed.select("doc_id", "size", "source_no", "start", "source_size", "words"))
    documents = placed.select("doc_id", "size", "source_no", "start").unionByName(
        named.where("size = 0").select("doc_id", "size", "source_no", F.lit(None).cast("bigint").alias("start"))
    )
    # A document lies at its place of every pass over the source, and a pass ends where all words are taken.
    passes = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("words") - 1 - F.col("start")) / F.col("source_size")))
    repeats = placed.where("words > start").select("source_no", "start", "size", "source_size", "words", F.explode(passes).alias("pass"))
    begin = F.col("pass") * F.col("source_size") + F.col("start")
    repeats = repeats.select("source_no", "start", "pass", begin.alias("_from"), F.least(begin + F.col("size"), "words").alias("_to"))

    def blocks(frame: DataFrame, low: Column, high: Column) -> DataFrame:
        return frame.withColumn("_block", F.explode(F.sequence(F.floor(low / block), F.floor((high - 1) / block))))

    served = schedule.select("slot", "source_no", F.col("start").alias("_low"), (F.col("start") + F.col("n")).alias("_high"))
    both = blocks(repeats, F.col("_from"), F.col("_to")).join(blocks(served, F.col("_low"), F.col("_high")), ["source_no", "_block"])
    low = F.greatest("_from", "_low", F.col("_block") * block)
    high = F.least("_to", "_high", (F.col("_block") + 1) * block)
    pieces = both.select("slot", "source_no", "start", "pass", (high - low).alias("n")).where("n > 0")
    return Mix(documents, sources.drop("lower"), schedule, pieces)


def taken(found: Mix) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target of its source, and the words the mix takes of it."""
    sums = found.pieces.groupBy("source_no", "start").agg(F.sum("n").alias("taken"))
    sources = small_side(found.sources.select("source_no", "source_size", "target"))
    return (
        found.documents.join(sums, ["source_no", "start"], "left")
        .join(sources, "source_no")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))
    )
