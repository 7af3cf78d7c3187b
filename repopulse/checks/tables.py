"""The supplied tables seen as repositories and discussions, in Spark and as SQL for the checks.

Main pair: suppliers as repositories, line items as discussions. Sparse pair: customers as
repositories, events as discussions; most customers have no event. Orphan pair: suppliers as
repositories, events as discussions; many events name no supplier. All rows of all tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _equal(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table; its schema is given, so that reading it starts no job of its own."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# --- main pair ----------------------------------------------------------------------------------

MAIN_REPOS = """
model_repos AS (
  SELECT s_suppkey AS id, s_name AS model_id, r_name AS tag,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'nation-' || n_name END AS author,
         CAST(trunc(s_acctbal) AS BIGINT) AS likes,
         (s_suppkey * 7919) % 10007 AS downloads,
         lower(n_name) AS pipeline_tag,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(s_nationkey AS INTEGER)) AS created_at,
         CASE WHEN s_acctbal >= 0
              THEN TIMESTAMP '1995-01-02 12:00:00' + to_days(CAST(s_nationkey AS INTEGER)) END AS last_modified
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

MAIN_DISCUSSIONS = """
discussions AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_suppkey AS repo_id, l_orderkey AS hf_discussion_num,
         'Part ' || l_partkey || ', "' || l_returnflag || '"' AS title,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE 'user-' || l_linenumber END AS author,
         l_returnflag = 'R' AS is_pull_request,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'merged'
              WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END AS status,
         CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN NULL ELSE l_shipdate END AS created_at,
         CASE WHEN l_linestatus = 'F' THEN o_orderdate END AS closed_at
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
)"""

MAIN = f"WITH {MAIN_REPOS}, {MAIN_DISCUSSIONS}\n"


def main_repos(spark: SparkSession, folder: str) -> DataFrame:
    joined = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), _equal("s_nationkey", "n_nationkey"))
        .join(table(spark, folder, "region"), _equal("n_regionkey", "r_regionkey"))
    )
    return joined.selectExpr(
        "s_suppkey AS id",
        "s_name AS model_id",
        "r_name AS tag",
        "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'nation-' || n_name END AS author",
        "CAST(s_acctbal AS BIGINT) AS likes",
        "(s_suppkey * 7919) % 10007 AS downloads",
        "lower(n_name) AS pipeline_tag",
        "TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(s_nationkey) AS created_at",
        "CASE WHEN s_acctbal >= 0 THEN TIMESTAMP_NTZ '1995-01-02 12:00:00' + make_dt_interval(s_nationkey) END"
        " AS last_modified",
    )


def main_discussions(spark: SparkSession, folder: str, closed_at: bool = True) -> DataFrame:
    """Line items as discussions. Order keys are unique, so queries that do not use ``closed_at``
    need not join the orders."""
    rows = table(spark, folder, "lineitem")
    columns = [
        "l_orderkey * 8 + l_linenumber AS id",
        "l_suppkey AS repo_id",
        "l_orderkey AS hf_discussion_num",
        "'Part ' || l_partkey || ', \"' || l_returnflag || '\"' AS title",
        "CASE WHEN l_linenumber = 2 THEN NULL ELSE 'user-' || l_linenumber END AS author",
        "l_returnflag = 'R' AS is_pull_request",
        "CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'merged'"
        " WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END AS status",
        "CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN NULL ELSE l_shipdate END AS created_at",
    ]
    if closed_at:
        rows = rows.join(table(spark, folder, "orders"), _equal("o_orderkey", "l_orderkey"), "left")
        columns.append("CASE WHEN l_linestatus = 'F' THEN o_orderdate END AS closed_at")
    return rows.selectExpr(*columns)


# --- sparse and orphan pairs --------------------------------------------------------------------

SPARSE_REPOS = """
model_repos AS (
  SELECT c_custkey AS id, c_name AS model_id, c_mktsegment AS tag, CAST(NULL AS VARCHAR) AS author,
         CAST(trunc(c_acctbal) AS BIGINT) AS likes, (c_custkey * 7919) % 10007 AS downloads
  FROM customer
)"""

EVENT_DISCUSSIONS = """
discussions AS (
  SELECT event_id AS id, user_id AS repo_id, event_id AS hf_discussion_num, event_type AS title,
         CAST(NULL AS VARCHAR) AS author, event_type = 'purchase' AS is_pull_request,
         CASE event_type WHEN 'error' THEN 'closed' WHEN 'signup' THEN ' Merged ' ELSE 'open' END AS status,
         ts AS created_at, CASE WHEN event_type = 'error' THEN ts END AS closed_at
  FROM events
)"""

SPARSE = f"WITH {SPARSE_REPOS}, {EVENT_DISCUSSIONS}\n"
ORPHANS = f"WITH {MAIN_REPOS}, {EVENT_DISCUSSIONS}\n"


def sparse_repos(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS id",
        "c_name AS model_id",
        "c_mktsegment AS tag",
        "CAST(NULL AS STRING) AS author",
        "CAST(c_acctbal AS BIGINT) AS likes",
        "(c_custkey * 7919) % 10007 AS downloads",
    )


def event_discussions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS id",
        "user_id AS repo_id",
        "event_id AS hf_discussion_num",
        "event_type AS title",
        "CAST(NULL AS STRING) AS author",
        "event_type = 'purchase' AS is_pull_request",
        "CASE event_type WHEN 'error' THEN 'closed' WHEN 'signup' THEN ' Merged ' ELSE 'open' END AS status",
        "ts AS created_at",
        "CASE WHEN event_type = 'error' THEN ts END AS closed_at",
    )


# --- records as delivered, with the faults that cleaning removes ---------------------------------

# Repositories: missing, empty and blank keys, outer white space, missing and negative counts,
# times in several spellings.
LISTED_MODELS = """
listed_models AS (
  SELECT CASE s_suppkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
              WHEN 3 THEN chr(160) || s_name || chr(9) ELSE s_name END AS id,
         CASE WHEN s_nationkey = 7 THEN NULL ELSE ' ' || r_name || chr(10) END AS tag,
         CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN chr(8195) ELSE ' by ' || n_name || ' ' END AS author,
         CASE WHEN s_nationkey = 4 THEN NULL ELSE CAST(trunc(s_acctbal) AS BIGINT) END AS likes,
         (s_suppkey * 7919) % 10007 - 100 AS downloads,
         n_name || ' ' AS pipeline_tag,
         CASE n_regionkey WHEN 0 THEN '1995-03-0' || (1 + s_suppkey % 9) WHEN 1 THEN '1995-03-04T05:06:07.250Z'
              WHEN 2 THEN '1995-03-04T05:06:07+02:00' WHEN 3 THEN 'last week' END AS created_at,
         CASE n_regionkey WHEN 0 THEN '1996' WHEN 1 THEN '1996-02-30' WHEN 2 THEN '1996-02-29 23:59' END AS last_modified,
         s_suppkey AS seq
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

LISTED_MODEL_TIMES = """
         CASE n_regionkey WHEN 0 THEN TIMESTAMP '1995-03-01 00:00:00' + to_days(CAST(seq % 9 AS INTEGER))
              WHEN 1 THEN TIMESTAMP '1995-03-04 05:06:07.25' WHEN 2 THEN TIMESTAMP '1995-03-04 03:06:07' END AS created_at,
         CASE n_regionkey WHEN 2 THEN TIMESTAMP '1996-02-29 23:59:00' END AS last_modified"""


def listed_models(spark: SparkSession, folder: str) -> DataFrame:
    joined = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), _equal("s_nationkey", "n_nationkey"))
        .join(table(spark, folder, "region"), _equal("n_regionkey", "r_regionkey"))
    )
    return joined.selectExpr(
        "CASE s_suppkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '"
        " WHEN 3 THEN '\\u00a0' || s_name || '\\t' ELSE s_name END AS id",
        "CASE WHEN s_nationkey = 7 THEN NULL ELSE ' ' || r_name || '\\n' END AS tag",
        "CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '\\u2003' ELSE ' by ' || n_name || ' ' END AS author",
        "CASE WHEN s_nationkey = 4 THEN NULL ELSE CAST(s_acctbal AS BIGINT) END AS likes",
        "(s_suppkey * 7919) % 10007 - 100 AS downloads",
        "n_name || ' ' AS pipeline_tag",
        "CASE n_regionkey WHEN 0 THEN '1995-03-0' || (1 + s_suppkey % 9) WHEN 1 THEN '1995-03-04T05:06:07.250Z'"
        " WHEN 2 THEN '1995-03-04T05:06:07+02:00' WHEN 3 THEN 'last week' END AS created_at",
        "CASE n_regionkey WHEN 0 THEN '1996' WHEN 1 THEN '1996-02-30' WHEN 2 THEN '1996-02-29 23:59' END"
        " AS last_modified",
        "s_suppkey AS seq",
    )


# Discussions: every order line is a record of its supplier; some suppliers also report a failure.
LISTED_DISCUSSIONS = """
listed_discussions AS (
  SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE ' ' || s_name END AS model_id,
         CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS num,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE chr(9) || 'Part ' || l_partkey || chr(160) END AS title,
         CASE WHEN l_linenumber = 4 THEN '  ' ELSE l_returnflag || ' ' END AS author,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag = 'R' END AS is_pull_request,
         CASE l_linenumber WHEN 1 THEN ' Closed ' WHEN 2 THEN 'CLOSED' WHEN 3 THEN NULL WHEN 4 THEN 'merged'
              WHEN 5 THEN '' ELSE 'open' END AS status,
         CASE l_linenumber WHEN 4 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS created_at,
         CASE WHEN l_linenumber < 3 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 12:30:00-0130' END AS closed_at,
         l_partkey * 1000000 + l_linenumber * 100000 + CAST(round(l_extendedprice) AS BIGINT) AS seq,
         l_shipdate, l_linenumber, l_returnflag, l_partkey, s_name, l_orderkey
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
)"""


def listed_discussions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "supplier"), _equal("s_suppkey", "l_suppkey"))
    return rows.selectExpr(
        "CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE ' ' || s_name END AS model_id",
        "CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS num",
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE '\\t' || 'Part ' || l_partkey || '\\u00a0' END AS title",
        "CASE WHEN l_linenumber = 4 THEN '  ' ELSE l_returnflag || ' ' END AS author",
        "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag = 'R' END AS is_pull_request",
        "CASE l_linenumber WHEN 1 THEN ' Closed ' WHEN 2 THEN 'CLOSED' WHEN 3 THEN NULL WHEN 4 THEN 'merged'"
        " WHEN 5 THEN '' ELSE 'open' END AS status",
        "CASE l_linenumber WHEN 4 THEN 'soon'"
        " ELSE date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") || 'Z' END AS created_at",
        "CASE WHEN l_linenumber < 3 THEN date_format(l_shipdate, 'yyyy-MM-dd') || ' 12:30:00-0130' END AS closed_at",
        "CAST(NULL AS STRING) AS fetch_error",
        "l_partkey * 1000000 + l_linenumber * 100000 + CAST(round(l_extendedprice) AS BIGINT) AS seq",
    )


def fetch_failures(spark: SparkSession, folder: str) -> DataFrame:
    """One failure record for each supplier with a negative balance."""
    return table(spark, folder, "supplier").filter("s_acctbal < 0").selectExpr(
        "s_name AS model_id",
        "CAST(NULL AS BIGINT) AS num",
        "CAST(NULL AS STRING) AS title",
        "CAST(NULL AS STRING) AS author",
        "CAST(NULL AS BOOLEAN) AS is_pull_request",
        "CAST(NULL AS STRING) AS status",
        "CAST(NULL AS STRING) AS created_at",
        "CAST(NULL AS STRING) AS closed_at",
        "'403 discussions disabled, nation ' || s_nationkey AS fetch_error",
        "CAST(NULL AS BIGINT) AS seq",
    )
