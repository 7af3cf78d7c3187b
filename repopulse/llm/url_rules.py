"""URL filter: hashed host-suffix and path-prefix expressions joined to a rule table.

Each distinct URL is expanded into expressions: every suffix of its host at a dot, combined with
every prefix of its path that is as long as some rule's path. Expressions meet the rules by an
equi-join on a short prefix of their SHA-256; the full digest confirms a match and the longest rule
wins. URLs are made distinct before they are expanded, so a page address that fills a third of the
table is expanded once; the joins are plain equi-joins, whose hot partitions Spark can split.

A null URL, or one without ``://``, has an empty host and path and fits no rule. Repeated rows are
judged alike. Other columns are kept; columns named host, path, rule or verdict are replaced.
Rules with a null host or path fit nothing; two verdicts for one rule resolve to the smaller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of the digest that the join uses.
PREFIX = 8


def _after_scheme(url: Column) -> Column:
    """From the first ``://`` on; null if there is none."""
    at = F.position(F.lit("://"), url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _expressions(lengths: Column) -> Column:
    """Host suffixes joined with path prefixes of the given lengths."""
    labels = F.split(F.col("host"), r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda host: F.transform(prefixes, lambda path: F.struct(host.alias("h"), path.alias("p")))))


def _digest(host: Column, path: Column) -> Column:
    """No host has a slash in it and paths start with one, so host and path stay apart."""
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every page.

    ``rules`` has host, path and verdict. The rule with the longest host and path together wins, then the one with the longer host.
    """
    table = (
        rules.where("host is not null and path is not null")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("_verdict"))
        .select(
            _digest(F.col("host"), F.col("path")).alias("_full"),
            F.concat("host", "path").alias("_rule"),
            F.length("host").alias("_host_length"),
            "_verdict",
        )
        .withColumn("_short", F.substring("_full", 1, PREFIX))
    )
    # One entry per length of rule path, so no longer than the longest rule.
    lengths = rules.where("host is not null and path is not null").agg(F.array_sort(F.collect_set(F.length("path")))).scalar()
    parts = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = (
        parts.where("path != ''")
        .select("host", "path")
        .distinct()
        .withColumn("_lengths", lengths)
        .withColumn("_e", F.explode(_expressions(F.col("_lengths"))))
        .select("host", "path", _digest(F.col("_e.h"), F.col("_e.p")).alias("_digest"))
        .withColumn("_short", F.substring("_digest", 1, PREFIX))
        .join(table, "_short")
        .where(F.col("_digest") == F.col("_full"))
        .groupBy("host", "path")
        .agg(
            F.max(F.struct(F.length("_rule").alias("n"), "_host_length", "_rule", F.col("_verdict").alias("v"))).alias("_best")
        )
    )
    return (
        parts.join(found, ["host", "path"], "left")
        .withColumns({"rule": F.col("_best._rule"), "verdict": F.coalesce("_best.v", F.lit(default))})
        .drop("_best")
    )
