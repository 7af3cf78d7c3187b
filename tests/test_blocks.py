"""Marked-up outputs."""

import io
import json
import random
import re
import time

import pandas as pd
from pyspark.sql import functions as F

from repopulse.operators import blocks

TABLE = "<<<TABLE_START>>>{}<<<TABLE_END>>>"
CHART = "<<<CHART_START>>>{}<<<CHART_END>>>"


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, stdout string")


def parsed(spark, text):
    return blocks.outputs(frame(spark, text), "stdout", "n").collect()[0]


def test_table_with_lead_text(spark, rows):
    text = "Counts per repo:\n" + TABLE.format("\nmodel_id,discussion_count\na/b,12\nc/d,3\n")
    out = parsed(spark, text)
    assert out.text_answer == "Counts per repo:" and not out.no_data and out.charts == []
    cells = blocks.table_cells(frame(spark, text), "stdout", "n")
    assert rows(cells, "row", "column", "value") == [
        (0, "discussion_count", "12"),
        (0, "model_id", "a/b"),
        (1, "discussion_count", "3"),
        (1, "model_id", "c/d"),
    ]


def test_chart_only(spark):
    figure = {"data": [{"type": "bar", "y": [1, 2]}], "layout": {}}
    out = parsed(spark, CHART.format(f"\n{json.dumps(figure)}\n"))
    assert [json.loads(c) for c in out.charts] == [figure] and out.tables == [] and out.text_answer == ""


def test_broken_charts_are_skipped_and_positions_kept(spark):
    text = CHART.format("{not json") + CHART.format("[1]") + CHART.format("") + CHART.format('{"a": null}')
    found = blocks.charts(frame(spark, text), "stdout", "n").orderBy("block").collect()
    assert [(r.block, r.chart) for r in found] == [(1, "[1]"), (3, '{"a": null}')]


def test_charts_equal_the_json_parser(spark):
    texts = [
        '{"a":1,"a":2}', '{"a": NaN, "b": [Infinity, -Infinity]}', '{"a":1} x', "[1]", "1", '"s"', "null", "{'a':1}", "", "[1],[2]",
        '{"a":1}{"b":2}', '{"a":[1,2}', "{a:1}", '{"a":"\\u00e9"}', "true", "tru", '{"a":1,}',
    ]
    texts += ["[" + ",".join(["1.5"] * 5_000_000) + "]", '"' + "x" * 20_000_000 + '"']

    def valid(text):
        try:
            json.loads(text)
        except ValueError:
            return False
        return True

    got = frame(spark, *texts).select("n", blocks.valid_json(F.col("stdout")).alias("ok")).collect()
    assert {r.n: r.ok for r in got} == {i: valid(t) for i, t in enumerate(texts)}


def test_unparsable_tables_are_left_out(spark):
    out = parsed(spark, TABLE.format("a\n1") + TABLE.format("a,b\n1,2\n1,2,3") + TABLE.format('a\n"x'))
    assert out.tables == ["a\n1"]


def test_no_data_word_anywhere(spark):
    assert parsed(spark, "NO_DATA").no_data
    assert parsed(spark, "xNO_DATAx").text_answer == "xNO_DATAx"
    assert not parsed(spark, "no_data").no_data


def test_empty_and_null_outputs(spark):
    for row in blocks.outputs(frame(spark, "", None, "  \n"), "stdout", "n").collect():
        assert (row.text_answer, row.no_data, row.tables, row.charts) == ("", False, [], [])
    assert blocks.table_cells(frame(spark, "", None), "stdout", "n").count() == 0


def test_table_and_chart_leave_the_text(spark):
    out = parsed(spark, "before " + TABLE.format("a\n1") + " between " + CHART.format("{}") + " after")
    assert out.text_answer == "before  between  after" and len(out.tables) == len(out.charts) == 1


def test_table_blocks_are_taken_out_first(spark):
    # A chart marker inside a table block goes with the table; the chart block is then open.
    text = TABLE.format("a\n1 <<<CHART_START>>>") + "rest<<<CHART_END>>>"
    out = parsed(spark, text)
    assert out.text_answer == "rest<<<CHART_END>>>" and out.charts == []


def pandas_cells(text):
    """Cells as pandas reads the blocks."""
    found = []
    for b, body in enumerate(re.findall(r"<<<TABLE_START>>>(.*?)<<<TABLE_END>>>", text, re.DOTALL)):
        try:
            table = pd.read_csv(io.StringIO(body.strip()), dtype=str)
        except Exception:  # noqa: BLE001
            continue
        index = [] if isinstance(table.index, pd.RangeIndex) else [list(v) if isinstance(v, tuple) else [v] for v in table.index]
        for i, values in enumerate(index):
            found += [(b, i, p - len(values), None, None if pd.isna(v) else str(v)) for p, v in enumerate(values)]
        for i in range(len(table)):
            for p, column in enumerate(table.columns):
                value = table.iloc[i, p]
                found.append((b, i, p, column, None if pd.isna(value) else value))
    return sorted(found, key=repr)


def test_cells_equal_pandas(spark, rows):
    texts = [
        TABLE.format("a,b\n1,2\n\n3,4\r\n5,6"),
        TABLE.format('a,b\n"x, y","say ""hi"""\n,NA\n"",null'),
        TABLE.format('a,b\n"two\nlines",1'),
        TABLE.format("a,b\n1\n2,3"),
        TABLE.format("a,b\n1,2\n1,2,3"),
        TABLE.format("a,b\n1,2,3\n4,5,6"),
        TABLE.format("a,b\n1,2,3\n4,5\n6"),
        TABLE.format('a,b\n"open,1'),
        TABLE.format('a,b\n5" pipe,3\n1,2'),
        TABLE.format('a,b\n"abc"def,1\n"a ""b""" c"d,2'),
        TABLE.format("a,b\n1,2\n  \t\n3,4"),
        TABLE.format("a,a,,a\n1,2,3,4"),
        TABLE.format("a,a,a.1\n1,2,3"),
        TABLE.format('a,b\nx "y,"z\n",1'),
        TABLE.format(""),
        TABLE.format(" \n\t") + TABLE.format("only"),
        TABLE.format(",b\n1,2").replace(",b", "z,b"),
        "t" + TABLE.format("x\n1") + TABLE.format("y\n2") + "t",
    ]
    for text in texts:
        got = rows(blocks.table_cells(frame(spark, text), "stdout"), "block", "row", "position", "column", "value")
        assert got == pandas_cells(text), text


def test_long_blocks_do_not_overflow(spark):
    rng = random.Random(1)
    lines = [f'{i},"{"x" * rng.randint(0, 40)}, ""q"" {"y" * 2000}"' for i in range(3000)]
    text = "lead " * 20000 + TABLE.format("i,v\n" + "\n".join(lines)) + "tail"
    cells = blocks.table_cells(frame(spark, text), "stdout", "n")
    assert cells.count() == 6000 and cells.filter("value IS NULL").count() == 0
    wide = TABLE.format(",".join(f'"c{i}"' for i in range(5000)) + "\n" + ",".join(f'"v {i}"' for i in range(5000)))
    assert blocks.table_cells(frame(spark, wide), "stdout", "n").count() == 5000


def test_infinities_and_byte_order_marks(spark):
    texts = ["Infinity", "[-Infinity, NaN]", "[+Infinity]", "[+INF]", "-INF", "INF", '["+INF", "a\\"+b"]', "1e+5", "[1E+2,-3]", "+1"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.ok for r in frame.select(blocks.valid_json(F.col("t")).alias("ok")).collect()] == [_loads(t) for t in texts]
    marked = spark.createDataFrame([(1, TABLE.format("\ufeffa,b\n1,2\n"))], "k int, t string")
    assert {r.column for r in blocks.table_cells(marked, "t", "k").collect()} == {"a", "b"}


def _loads(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def test_header_names_equal_pandas(spark, rows):
    draw = random.Random(5)
    pool = ["a", "a", "b", "", "", "a.1", "a.2", "a.3", "a.1.1", "a.01", "a.0", ".1", "b.2", "Unnamed: 1", "Unnamed: 2.1", "a.99999999999", "é.1", "é"]
    headers = [[draw.choice(pool) for _ in range(draw.randint(2, 14))] for _ in range(300)]
    headers += [["", "Unnamed: 0"], ["a.1", "a", "a"], ["a", "a.2", "a", "a", "a"], ["Unnamed: 1", ""]]
    texts = [TABLE.format(",".join(h) + "\n" + ",".join("x" * len(h))) for h in headers]
    cells = blocks.table_cells(frame(spark, *texts), "stdout", "n").select("n", "position", "column").collect()
    got = {}
    for n, position, column in cells:
        got.setdefault(n, {})[position] = column
    for i, header in enumerate(headers):
        expected = list(pd.read_csv(io.StringIO(",".join(header) + "\n" + ",".join("x" * len(header))), dtype=str).columns)
        assert [got[i][p] for p in sorted(got[i])] == expected, header


def test_header_of_many_equal_names(spark):
    width = 20_000
    header = ["a"] * width + [f"a.{2 * k}" for k in range(1, width)]
    text = TABLE.format(",".join(header) + "\n" + ",".join(["1"] * len(header)))
    start = time.perf_counter()
    found = blocks.table_cells(frame(spark, text), "stdout", "n").select("position", "column").collect()
    assert time.perf_counter() - start < 30
    names = [column for _, column in sorted(found)]
    free = [f"a.{k}" for k in range(1, 2 * width) if k % 2 or k >= 2 * width]
    assert names[:width] == ["a", *free[: width - 1]] and names[width:] == header[width:]
