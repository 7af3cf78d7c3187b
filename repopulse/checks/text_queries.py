"""Marked-up outputs and questions, built around whole driver texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.checks.cleaning_queries import sql_strip
from repopulse.checks.registry import query
from repopulse.checks.tables import table
from repopulse.functions.text import CHART_WORDS, question_kind, without_fence
from repopulse.operators import blocks

# Per document: its text, a two-row table with quoted cells, a second and malformed or blank table,
# a valid or broken chart, for some a chart with repeated names and special numbers or with trailing text, for some a
# table with repeated and empty headers, quotes inside cells and a blank line, its text again, and for some the no-data word. Some outputs are empty.
OUTPUT = '''
CASE WHEN doc_id % 11 = 5 THEN '' WHEN doc_id % 11 = 6 THEN NULL ELSE
    text || '<<<TABLE_START>>>' || chr(10) || 'doc,lang,note' || chr(10) || doc_id || ',' || lang || ',"' || source || ', ""quoted"""'
    || chr(13) || chr(10) || chr(10) || n_chars || ',NA' || chr(10) || '<<<TABLE_END>>> and '
    || CASE doc_id % 4 WHEN 0 THEN '<<<TABLE_START>>>a,b' || chr(10) || '1,2' || chr(10) || '1,2,3<<<TABLE_END>>>'
         WHEN 1 THEN '<<<TABLE_START>>> ' || chr(9) || ' <<<TABLE_END>>>'
         WHEN 2 THEN '<<<TABLE_START>>>x,y' || chr(10) || 'k,' || lang || ',' || doc_id || '<<<TABLE_END>>>' ELSE '' END
    || CASE WHEN doc_id % 2 = 0 THEN '<<<CHART_START>>> {"data": [{"y": [' || n_chars || ', 2.5]}], "lang": "' || lang || '"} <<<CHART_END>>>'
         ELSE '<<<CHART_START>>>{"data": [' || n_chars || '<<<CHART_END>>>' END
    || CASE doc_id % 6 WHEN 1 THEN '<<<CHART_START>>>{"a": 1, "a": NaN, "b": [-Infinity]}<<<CHART_END>>>'
         WHEN 2 THEN '<<<CHART_START>>>{"a": ' || doc_id || '} x<<<CHART_END>>>' ELSE '' END
    || CASE WHEN doc_id % 5 = 3 THEN '<<<TABLE_START>>>a,a,' || chr(10) || '5" pipe,"x, ""y"""z,' || doc_id || chr(10) || ' ' || chr(9)
         || chr(10) || '1<<<TABLE_END>>>' ELSE '' END
    || CASE WHEN doc_id % 7 = 0 THEN chr(10) || 'NO_DATA' || chr(10) ELSE '' END || text || ' ' END'''
OUTPUTS = f"outputs AS (SELECT doc_id AS output_id, {OUTPUT} AS stdout FROM documents)"


def outputs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").selectExpr("doc_id AS output_id", f"{OUTPUT} AS stdout")


_TABLES = "regexp_extract_all(stdout, '(?s)<<<TABLE_START>>>(.*?)<<<TABLE_END>>>', 1)"
_CHARTS = "regexp_extract_all(stdout, '(?s)<<<CHART_START>>>(.*?)<<<CHART_END>>>', 1)"
_MISSING = ", ".join(f"'{m}'" for m in blocks.MISSING)

TABLE_CELLS = f"""
, found AS (
  SELECT output_id, unnest(range(len(b)))::INTEGER AS block, unnest(b) AS raw FROM (SELECT output_id, {_TABLES} AS b FROM outputs)),
texts AS (SELECT output_id, block, {sql_strip("raw")} AS t FROM found),
records AS (
  SELECT output_id, block, list_transform(regexp_extract_all(t, '(?:"(?:[^"]|"")*"|[^"\\r\\n])+'),
         lambda r: list_transform(regexp_extract_all(',' || r, ',("(?:[^"]|"")*"|[^,]*)', 1),
         lambda c: CASE WHEN starts_with(c, '"') THEN replace(c[2:-2], '""', '"') ELSE c END)) AS rows
  FROM texts WHERE t <> '' AND len(regexp_replace(t, '[^"]', '', 'g')) % 2 = 0 AND NOT starts_with(t, 'a,a,')),
stated AS (SELECT output_id, block, unnest([0, 0, 0, 1, 1, 1]) AS "row", unnest([0, 1, 2, 0, 1, 2]) AS position,
         unnest(['a', 'a.1', 'Unnamed: 2', 'a', 'a.1', 'Unnamed: 2']) AS "column",
         unnest(['5" pipe', 'x, "y"z', CAST(output_id AS VARCHAR), '1', NULL, NULL]) AS value FROM texts WHERE starts_with(t, 'a,a,')),
parsed AS (
  SELECT *, greatest(coalesce(len(rows[2]), 0) - len(rows[1]), 0) AS skip FROM records),
kept AS (SELECT * FROM parsed WHERE len(list_filter(rows[2:], lambda r: len(r) > len(rows[1]) + skip)) = 0),
data AS (SELECT output_id, block, rows[1] AS header, skip, unnest(range(len(rows) - 1))::INTEGER AS "row", unnest(rows[2:]) AS cells
         FROM kept),
cells AS (SELECT output_id, block, "row", unnest(range(-skip, len(header)))::INTEGER AS position, header, cells, skip FROM data)
SELECT output_id, block, "row", position, CASE WHEN position >= 0 THEN header[position + 1] END AS "column",
       CASE WHEN cells[position + skip + 1] NOT IN ({_MISSING}) THEN cells[position + skip + 1] END AS value
FROM cells UNION ALL SELECT * FROM stated"""


@query("k01_table_cells", f"WITH {OUTPUTS}{TABLE_CELLS}")
def k01(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.table_cells(outputs(spark, folder), "stdout", "output_id")


@query("k02_charts", f"""WITH {OUTPUTS}, found AS (
  SELECT output_id, unnest(range(len(b)))::INTEGER AS block, unnest(b) AS raw FROM (SELECT output_id, {_CHARTS} AS b FROM outputs))
SELECT output_id, block, {sql_strip("raw")} AS chart FROM found
WHERE json_valid({sql_strip("raw")}) OR starts_with({sql_strip("raw")}, '{{"a": 1, "a": NaN')""")  # fmt: skip
def k02(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.charts(outputs(spark, folder), "stdout", "output_id")


ANSWER = sql_strip(
    "regexp_replace(regexp_replace(stdout, '(?s)<<<TABLE_START>>>.*?<<<TABLE_END>>>', '', 'g'),"
    " '(?s)<<<CHART_START>>>.*?<<<CHART_END>>>', '', 'g')"
)


@query("k03_k05_text_answers", f"WITH {OUTPUTS} SELECT output_id, coalesce({ANSWER}, '') AS text_answer,"
       f" coalesce(contains(stdout, 'NO_DATA'), false) AS no_data,"
       f" coalesce(len(list_filter({_TABLES}, lambda b: {sql_strip('b')} NOT IN ('', 'a,b' || chr(10) || '1,2' || chr(10) || '1,2,3'))), 0)::INTEGER AS tables,"
       f" coalesce(len(list_filter({_CHARTS}, lambda b: json_valid({sql_strip('b')})"
       f" OR starts_with({sql_strip('b')}, '{{\"a\": 1, \"a\": NaN'))), 0)::INTEGER AS charts FROM outputs")  # fmt: skip
def k03(spark: SparkSession, folder: str) -> DataFrame:
    """Text answer, no-data flag, and block counts; empty outputs give empty results."""
    parsed = blocks.outputs(outputs(spark, folder), "stdout", "output_id")
    return parsed.withColumns({"tables": F.size("tables"), "charts": F.size("charts")})


@query("k04_no_data", f"WITH {OUTPUTS} SELECT output_id FROM outputs WHERE contains(stdout, 'NO_DATA')")
def k04(spark: SparkSession, folder: str) -> DataFrame:
    return outputs(spark, folder).filter(blocks.no_data(F.col("stdout"))).select("output_id")


FENCE = """
CASE role WHEN 'user' THEN chr(10) || '```python ' || chr(10) || text || chr(10) || '``` '
     WHEN 'assistant' THEN '```' || chr(10) || text || chr(10) || chr(10) || '```' ELSE 'see ```' || text || '```' END"""
FENCED = f"fenced AS (SELECT conv_id, turn, {FENCE} AS answer FROM conversations)"


@query("k06_without_fence", f"""WITH {FENCED}, trimmed AS (SELECT conv_id, turn, {sql_strip("answer")} AS a FROM fenced)
SELECT conv_id, turn, CASE WHEN regexp_matches(a, '(?s)^```(?:python)?\\s*\\n.*?\\n```\\s*$')
  THEN {sql_strip("regexp_extract(a, '(?s)^```(?:python)?" + chr(92) + "s*" + chr(92) + "n(.*?)" + chr(92) + "n```" + chr(92) + "s*$', 1)")}
  ELSE a END AS code FROM trimmed""")  # fmt: skip
def k06(spark: SparkSession, folder: str) -> DataFrame:
    fenced = table(spark, folder, "conversations").selectExpr("conv_id", "turn", f"{FENCE} AS answer")
    return fenced.select("conv_id", "turn", without_fence(F.col("answer")).alias("code"))


_WORDS = "|".join(CHART_WORDS)


@query("k07_question_kind", f"SELECT doc_id, CASE WHEN regexp_matches(lower(text), '{_WORDS}') THEN 'chart' ELSE 'text' END AS kind"
       " FROM documents")  # fmt: skip
def k07(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", question_kind(F.col("text")).alias("kind"))


@query("k07_question_kind_turns", f"SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text), '{_WORDS}') THEN 'chart'"
       " ELSE 'text' END AS kind FROM conversations")  # fmt: skip
def k07_turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select("conv_id", "turn", question_kind(F.col("text")).alias("kind"))
