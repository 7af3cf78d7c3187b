"""Benchmark decontamination: size-partitioned MinHash search for short items inside long documents.

Containment is the share of an item's distinct five-word shingles that a document has. Under one
hash permutation the k smallest values of an item are its sketch. Items are partitioned by their
number of shingles, and each partition gets a k from its largest size, such that an item of
threshold containment must share at least one sketch value: of n shingles at most
n - ceil(threshold * n) are missing. The search therefore loses nothing, however long a document
is. Sketch values are small by construction; document values above the largest one are dropped
inside the row, before anything is joined.

Candidates are verified on the shingles themselves. Built-in functions only; texts are compared as
lower-cased words of letters, marks and digits.

Null, empty and short texts (under five words) have no shingles: such items match nothing and such
documents hold nothing. Repeated item rows count once; copies of a document are each reported. Null
ids are values like any other. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.columns import plain_words, shingle_hashes, shingles
from repopulse.session import settle, small_side

#: Size partitions in each doubling of the number of shingles.
PER_DOUBLING = 4


def text_key(text: Column) -> Column:
    """Equal for equal texts."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def item_sketches(items: DataFrame, threshold: float, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_key, item_id, grams, n, partition and the sketch of every item with a shingle."""
    sized = (
        items.select(F.col(item_id).alias("item_id"), F.coalesce(text, F.lit("")).alias("_text"))
        .distinct()
        .withColumn("item_key", F.sha2(F.concat_ws("\n", F.col("item_id").cast("string"), F.col("_text")), 256))
        .withColumn("_words", plain_words(F.col("_text")))
        .withColumn("grams", F.array_distinct(shingles(F.col("_words"))))
        .withColumn("n", F.size("grams"))
        .where("n > 0")
        .withColumn("partition", F.ceil(PER_DOUBLING * F.log2(F.col("n"))))
        # The largest size of the partition; rounding must not make it smaller than a member.
        .withColumn("_most", F.greatest(F.floor(F.pow(F.lit(2.0), F.col("partition") / PER_DOUBLING)), F.col("n")))
        .withColumn("_k", (F.col("_most") - F.ceil(threshold * F.col("_most") - 1e-9) + 1).cast("int"))
    )
    values = F.array_sort(F.array_distinct(shingle_hashes(F.col("_words"))))
    return sized.withColumn("sketch", F.slice(values, F.lit(1), F.col("_k"))).select(
        "item_key", "item_id", "grams", "n", "partition", "sketch"
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_shared, containment) of every document and item at or above the threshold."""
    sketches = settle(item_sketches(items, threshold, item_id, text))
    values = small_side(sketches.select("item_key", F.explode("sketch").alias("value")).distinct())
    bound = values.agg(F.max("value")).scalar()

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    candidates = (
        texts.withColumn("_bound", bound)
        .where("_bound is not null")
        .select(
            text_key(F.col("_text")).alias("text_key"),
            F.explode(F.filter(shingle_hashes(plain_words(F.col("_text"))), lambda h: h <= F.col("_bound"))).alias("value"),
        )
        .join(values, "value")
        .select("text_key", "item_key")
        .distinct()
    )
    candidates = small_side(candidates)
    checked = (
        texts.withColumn("text_key", text_key(F.col("_text")))
        .join(candidates, "text_key")
        .join(small_side(sketches.select("item_key", "item_id", "grams", "n"), 10_000), "item_key")
        .withColumn("n_shared", F.size(F.array_intersect("grams", shingles(plain_words(F.col("_text"))))))
        .withColumn("containment", F.col("n_shared") / F.col("n"))
        .where(F.col("containment") >= threshold)
    )
    return (
        checked.groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.struct("containment", "n_shared", F.col("n").alias("n_item"))).alias("_best"))
        .select("doc_id", "text_key", "item_id", "_best.n_item", "_best.n_shared", "_best.containment")
    )


def remove_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """Documents that hold no item, with their columns as they are."""
    numbered = docs.select(F.lit(0).alias("doc_id"), F.col(text).alias("text"))
    leaking = find_leaks(numbered, items.select("item_id", "text"), threshold).select(F.col("text_key").alias("_leak")).distinct()
    return docs.join(leaking, text_key(F.col(text)) == F.col("_leak"), "left_anti")
