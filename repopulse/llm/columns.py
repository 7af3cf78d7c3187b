"""Column expressions that several corpus operators share. No user functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: What plain_words() treats as separators: all but letters, marks and digits.
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"
SHINGLE = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """Words between blanks; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def plain_words(text: Column) -> Column:
    """Lower-cased words of letters, marks and digits; null texts have none."""
    spaced = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _windows(words: Column, of_window: Callable[[Column, Column], Column], kind: str) -> Column:
    """One entry for each run of five words."""
    return let(
        words,
        lambda w: F.when(F.size(w) < SHINGLE, F.array().cast(f"array<{kind}>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: of_window(w, i))
        ),
    )


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of the five-word shingles, in text order."""
    return _windows(words, lambda w, i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))), "bigint")


def shingles(words: Column) -> Column:
    """The five-word shingles themselves, in text order."""
    return _windows(words, lambda w, i: F.concat_ws(" ", *(F.get(w, i + k) for k in range(SHINGLE))), "string")
