"""Quality rules: a table of thresholds compiled into one projection.

Each rule bounds one measure of a text. All measures are built-in expressions over the row, so a
decision costs one scan, no shuffle and no user function, and hot sources or copies make no
difference. The order of rows, copies and ties have no influence.

Null, empty and blank texts have no words: their counts are 0, ratios 0, and they fail
``min_words``. Other columns are kept; a column named like a measure is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.columns import BLANKS, SHINGLE, let, shingle_hashes, split_words

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the of and to in is that it for was with on as by be are from at this have "
    "der die das und ist nicht mit von zu den ein eine im auf sich des dem für "
    "le la les de et un une que qui est en dans pour par du au "
    "el los las y por con para del se su".split()
)


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``measure`` lies outside [least, most], if it has ``from_words`` words or more."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0

    def failed(self) -> Column:
        value = F.col(self.measure)
        outside = F.lit(False)
        if self.least is not None:
            outside = outside | (value < self.least)
        if self.most is not None:
            outside = outside | (value > self.most)
        return outside & (F.col("n_words") >= self.from_words)


RULES = (
    Rule("word_length", "mean_word_chars", least=2.0, most=14.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.03, from_words=20),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a five-word window which the text holds twice or more.

    Windows are compared by 64-bit hashes. If all hashes differ, nothing is repeated and the sort
    is skipped. Otherwise windows are sorted by hash; those that equal a neighbour are repeated,
    and the words that their start positions cover are counted once each.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, j: F.least(F.lit(SHINGLE), F.coalesce(F.get(starts, j + 1) - p, F.lit(SHINGLE))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def starts(placed: Column) -> Column:
        twin = F.filter(
            placed,
            lambda x, j: (x["h"] == F.get(placed, j + 1)["h"]) | ((j > 0) & (x["h"] == F.get(placed, F.greatest(j - 1, F.lit(0)))["h"])),
        )
        return F.sort_array(F.transform(twin, lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(let(placed, starts), covered)
        )

    return let(shingle_hashes(words), count)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and the ratios that rules use.

    n_dup_lines counts lines with a word that equal an earlier line.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counts = let(
        split_words(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("bigint").alias("_stop"),
        ),
    )
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    symbols = F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))
    ratio = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    found = docs.withColumns({"_words": counts, "_lines": line_counts}).withColumns(
        {
            "n_words": F.col("_words.n_words"),
            "word_chars": F.col("_words.word_chars"),
            "n_symbols": symbols.cast("bigint"),
            "n_dup_lines": F.col("_lines.n_dup_lines"),
            "n_repeat_words": F.col("_words.n_repeat_words"),
            "n_lines": F.col("_lines.n_lines"),
            "_stop": F.col("_words._stop"),
        }
    )
    return found.withColumns(
        {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "stop_word_ratio": ratio("_stop", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        }
    ).drop("_words", "_lines", "_stop")


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    min_words: int = 10,
    most_repeated_percent: int = 20,
) -> DataFrame:
    """Add the measures, base_failed, the names of failed rules and kept.

    base_failed: fewer than ``min_words`` words, or more than ``most_repeated_percent`` of them in
    repeated windows. kept is false where the base or any rule fails.
    """
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated_percent * F.col("n_words"))
    failed = F.filter(F.array(*(F.when(rule.failed(), F.lit(rule.name)) for rule in rules)), lambda x: x.isNotNull())
    return (
        measure(docs, text)
        .withColumns({"base_failed": base, "failed_rules": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def keep(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are kept, with their own columns.

    The verdict passes through a generator before the filter. A filter right on the projection would take in
    the whole measuring expression once for each time that the verdict names a measure.
    """
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(text).alias("text"))
    judged = judge(held, "text", **options).select(F.inline(F.array(F.struct("_row", "kept"))))
    return judged.where("kept").select("_row.*")
