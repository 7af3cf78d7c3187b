"""Tables, charts and text inside marked-up outputs, one output per row.

Everything is a regular expression over the whole text, evaluated inside the scan stage: no
shuffle, no Python, and quantifiers that do not backtrack over long values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.text import strip

# The markers and the no-data word.
TABLE_BLOCK = r"(?s)<<<TABLE_START>>>(.*?)<<<TABLE_END>>>"
CHART_BLOCK = r"(?s)<<<CHART_START>>>(.*?)<<<CHART_END>>>"
NO_DATA = "NO_DATA"

# Cells that mean a missing value in comma-separated text.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A quote opens a quotation at the start of a cell only; text after the closing quote belongs to the cell.
_QUOTED = r'"(?:[^"]++|"")*+"'
_AT_START = r"(?<=\A|[,\r\n])"
_RECORD = rf'((?:{_AT_START}{_QUOTED}|[^",\r\n]++|[",])++)'
_CELL = rf",((?:{_QUOTED})?+[^,]*+)"
_OPEN_QUOTE = rf'{_AT_START}"'

_JSON_STRING = r'"(?:[^"\\]++|\\.)*+"'
_JSON_OPTIONS = {"allowNonNumericNumbers": "true", "allowSingleQuotes": "false", "maxStringLen": "2147483647"}


def table_blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TABLE_BLOCK), F.lit(1))


def chart_blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHART_BLOCK), F.lit(1))


def text_answer(text: Column) -> Column:
    """The text around the blocks; table blocks are taken out first."""
    rest = F.regexp_replace(F.regexp_replace(text, TABLE_BLOCK, ""), CHART_BLOCK, "")
    return F.coalesce(strip(rest), F.lit(""))


def no_data(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit(NO_DATA)), F.lit(False))


def valid_json(text: Column) -> Column:
    """Exactly one JSON value of any size. Nesting beyond about a thousand levels counts as invalid.

    Spark's parser knows more infinities than ``Infinity`` and ``-Infinity``; the others are refused.
    """
    one = F.from_json(F.concat(F.lit('{"c":['), text, F.lit("]}")), "c array<string>, _corrupt_record string", _JSON_OPTIONS)
    other_infinity = F.regexp_replace(text, _JSON_STRING, "").rlike(r"(?:\A|[^eE])\+|INF")
    return F.coalesce((F.size(one["c"]) == 1) & one["_corrupt_record"].isNull() & ~other_infinity, F.lit(False))


def outputs(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """One row per output: text answer, no-data flag, texts of tables that parse and of valid charts.

    Null and empty outputs give empty results.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    return df.select(
        *keys,
        text_answer(source).alias("text_answer"),
        no_data(source).alias("no_data"),
        F.filter(F.transform(table_blocks(source), strip), _readable).alias("tables"),
        F.filter(F.transform(chart_blocks(source), strip), valid_json).alias("charts"),
    )


def charts(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """One row per valid chart: its position among all chart blocks and its JSON."""
    blocks = F.transform(chart_blocks(F.col(text)), strip)
    return df.select(*keys, F.posexplode(blocks).alias("block", "chart")).filter(valid_json(F.col("chart")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _unquoted(cell: Column) -> Column:
    whole = rf"(?s)\A({_QUOTED})(.*)\z"
    quoted = F.regexp_extract(cell, whole, 1)
    inner = F.replace(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit('""'), F.lit('"'))
    return F.when(quoted != "", F.concat(inner, F.regexp_extract(cell, whole, 2))).otherwise(cell)


def _cells(record: Column) -> Column:
    # A leading comma gives every cell its own separator, so empty first cells are found too.
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), F.lit(1)), _unquoted)


def _closed(text: Column) -> Column:
    """Not empty, and every quotation that a cell begins with ends."""
    return (text != "") & ~F.regexp_replace(text, rf"{_AT_START}{_QUOTED}", "q").rlike(_OPEN_QUOTE)


def _records(text: Column) -> Column:
    """Cells of every line that is not blank."""
    lines = F.filter(F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1)), lambda r: F.btrim(r, F.lit(" \t")) != "")
    return F.transform(lines, _cells)


def _leading(rows: Column) -> Column:
    """Cells by which the first data row is longer than the header: they form the row's index."""
    return F.greatest(F.coalesce(F.size(F.get(rows, F.lit(1))), F.lit(0)) - F.size(F.get(rows, F.lit(0))), F.lit(0))


def _fits(rows: Column) -> Column:
    """No row has more cells than the index and the header."""
    return F.array_max(F.transform(rows, F.size)) <= F.size(F.get(rows, F.lit(0))) + _leading(rows)


def _readable(text: Column) -> Column:
    return F.when(_closed(text), _let(_records(text), _fits)).otherwise(False)


#: A name that looks like a repeated one: the name before it, and a number without leading zeros.
_NUMBERED = r"(?s)\A(.*)\.([1-9][0-9]{0,8})\z"


def _runs(rows: Column) -> Column:
    """A sorted array of structs, cut where the field ``name`` changes."""

    def cut(rows: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["name"] != F.get(rows, i - 1)["name"])
        )
        return _let(
            starts,
            lambda s: F.transform(s, lambda at, j: F.slice(rows, at + 1, F.coalesce(F.get(s, j + 1), F.size(rows)) - at)),
        )

    return _let(rows, cut)


def _numbered(run: Column) -> Column:
    """(position, name) of all columns of one name, from the numbers that are taken and the columns in order.

    The m-th repetition gets the m-th number that is not taken. If the i-th taken number (from 0) is s, then s - i
    numbers up to s are free, so it comes before the repetitions m >= s - i: sorted together, the place is the number.
    """
    taken = F.transform(F.filter(run, lambda r: r["kind"] == 0), lambda r, i: F.struct((r["number"] - i).alias("at"), F.lit(0), F.lit(-1).alias("position")))

    def name_all(columns: Column) -> Column:
        repeated = F.transform(
            F.slice(columns, F.lit(2), F.size(columns)), lambda c, m: F.struct((m + 1).alias("at"), F.lit(1), c["position"].alias("position"))
        )
        name = F.get(columns, F.lit(0))["name"]
        placed = F.transform(
            F.sort_array(F.concat(taken, repeated)),
            lambda r, place: F.struct(r["position"].alias("position"), F.concat(name, F.lit("."), (place + 1).cast("string")).alias("name")),
        )
        first = F.transform(F.slice(columns, 1, 1), lambda c: F.struct(c["position"].alias("position"), c["name"].alias("name")))
        return F.concat(first, F.filter(placed, lambda p: p["position"] >= 0))

    return _let(F.filter(run, lambda r: r["kind"] == 1), name_all)


def _distinct_names(header: Column) -> Column:
    """Header names made distinct: empty ones get their place, repeated ones a number that is still free.

    Columns that were named in the header keep their names before those that were not. Names are sorted with the
    numbers that the header itself takes, so the cost is that of two sorts, however often names repeat.
    """

    def entries(raw: Column) -> Column:
        columns = F.transform(
            raw,
            lambda name, i: F.struct(
                name.alias("name"), F.lit(1).alias("kind"), (F.get(header, i) == "").cast("int").alias("number"), i.alias("position")
            ),
        )
        taken = F.transform(
            F.filter(F.array_distinct(raw), lambda name: name.rlike(_NUMBERED)),
            lambda name: F.struct(
                F.regexp_extract(name, _NUMBERED, 1).alias("name"),
                F.lit(0).alias("kind"),
                F.regexp_extract(name, _NUMBERED, 2).cast("int").alias("number"),
                F.lit(-1).alias("position"),
            ),
        )
        return F.sort_array(F.concat(taken, columns))

    def distinct(raw: Column) -> Column:
        named = F.sort_array(F.flatten(F.transform(_runs(entries(raw)), _numbered)))
        return F.when(F.size(F.array_distinct(raw)) == F.size(raw), raw).otherwise(F.transform(named, lambda c: c["name"]))

    return _let(
        F.transform(header, lambda name, i: F.when(name == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(name)), distinct
    )


def table_cells(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """Cells of all table blocks as ``block, row, position, column, value``.

    Headers differ per block, hence the long form with text values. Blank blocks and blank lines are
    skipped, and so are whole blocks that do not parse: an open quote, or a row with more cells than
    the first data row and the header allow. Leading cells of rows that are longer than the header
    form the rows' index: they have positions below 0 and no column. Short rows are filled with nulls.
    """
    blocks = df.select(*keys, F.posexplode(table_blocks(F.col(text))).alias("block", "_raw"))
    blocks = blocks.withColumn("_raw", F.regexp_replace("_raw", r"\A\x{FEFF}", ""))  # a byte order mark is no text
    # Each step goes through a generator. Its output is a plain column to the optimizer, which would
    # otherwise copy the parsing expression into every later use, once per row of the block.
    texts = _materialised(blocks, [*keys, "block"], _text=strip(F.col("_raw")))
    parsed = _materialised(texts.filter(_closed(F.col("_text"))), [*keys, "block"], _rows=_records(F.col("_text")))
    headed = _materialised(
        parsed.filter(_fits(F.col("_rows"))), [*keys, "block"], _names=F.get("_rows", F.lit(0)), _rows=F.col("_rows")
    )
    shaped = _materialised(
        headed,
        [*keys, "block"],
        _header=_distinct_names(F.col("_names")),
        _data=F.slice("_rows", F.lit(2), F.greatest(F.size("_rows") - 1, F.lit(0))),
        _skip=_leading(F.col("_rows")),
    )
    rows = shaped.select(*keys, "block", "_header", "_skip", F.posexplode("_data").alias("row", "_cells"))
    cell = F.transform(
        F.sequence(-F.col("_skip"), F.size("_header") - 1),
        lambda i: F.struct(
            i.alias("position"),
            F.when(i >= 0, F.get("_header", i)).alias("column"),
            F.get("_cells", i + F.col("_skip")).alias("value"),
        ),
    )
    cells = rows.select(*keys, "block", "row", F.explode(cell).alias("_cell"))
    value = F.col("_cell.value")
    return cells.select(
        *keys,
        "block",
        "row",
        "_cell.position",
        "_cell.column",
        F.when(~value.isin(*MISSING), value).alias("value"),
    )


def _materialised(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` plus new columns, each computed exactly once per row."""
    made = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*keep, F.inline(F.array(made)))
