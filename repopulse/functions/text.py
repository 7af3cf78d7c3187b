"""String cleaning and classification as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a value is cleaned.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A question holding one of these, even inside a longer word, asks for a chart.
CHART_WORDS = (
    "chart", "plot", "graph", "forecast", "visual", "pie", "bar",
    "line", "stacked", "stack", "trend", "histogram",
)

# Fixed pattern: the whole text is one fenced block, with an optional language name.
FENCE = r"(?s)\A```(?:python)?\s*\n(.*?)\n```\s*\z"


def strip(column: Column) -> Column:
    """Remove white space of every kind from both ends (``trim`` only removes spaces).

    Looks at the ends of the text only, where a pattern would walk through all of it.
    """
    return F.btrim(column, F.lit(WHITE_SPACE))


def optional_string(column: Column) -> Column:
    """Stripped value, null when nothing is left."""
    return F.nullif(strip(column), F.lit(""))


def required_string(column: Column) -> Column:
    """Stripped value, empty when missing."""
    return F.coalesce(strip(column), F.lit(""))


def canonical_status(column: Column) -> Column:
    """``closed`` for any spelling of closed, ``open`` for everything else and for null."""
    return F.when(F.lower(strip(column)) == "closed", "closed").otherwise("open")


def listed_status(column: Column) -> Column:
    """The narrower rule of the listing itself: case is ignored, surrounding blanks are not."""
    return F.when(F.lower(column) == "closed", "closed").otherwise("open")


def without_fence(column: Column) -> Column:
    """Body of a text that is one fenced block; any other text only loses its outer white space."""
    text = strip(column)
    return F.when(text.rlike(FENCE), strip(F.regexp_extract(text, FENCE, 1))).otherwise(text)


def question_kind(column: Column) -> Column:
    """Twelve plain substring tests, which on long texts are much faster than one pattern."""
    text = F.lower(column)
    asks = reduce(or_, (F.contains(text, F.lit(word)) for word in CHART_WORDS))
    return F.when(asks, "chart").otherwise("text")
