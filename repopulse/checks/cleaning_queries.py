"""Sources, cleaning rules, derived tables, upserts, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.checks.activity_queries import PER_REPO, RATES, _with_totals, as_double, main
from repopulse.checks.registry import query
from repopulse.checks.tables import (
    EVENT_DISCUSSIONS,
    LISTED_DISCUSSIONS,
    LISTED_MODEL_TIMES,
    LISTED_MODELS,
    MAIN,
    MAIN_REPOS,
    SPARSE_REPOS,
    event_discussions,
    fetch_failures,
    listed_discussions,
    listed_models,
    main_discussions,
    main_repos,
    sparse_repos,
    table,
)
from repopulse.functions.text import listed_status
from repopulse.functions.time import parse_iso, weekday_name
from repopulse.operators import cleaning, joins, ranking, upsert, views
from repopulse.plans.ingest import load
from repopulse.schemas import DISCUSSIONS, MODEL_REPOS, enforce
from repopulse.session import shared_folder
from repopulse.sources import csv_files, landing, run_log, tables

# Outer white space of every kind, for the SQL side.
BLANK = r"[\s\x0b\p{Z}\x1c-\x1f\x{85}]"


def sql_strip(column: str) -> str:
    return f"regexp_replace({column}, '^{BLANK}+|{BLANK}+$', '', 'g')"


# --- sources and sinks --------------------------------------------------------------------------


@query("a01_table_scan", MAIN + "SELECT * FROM discussions")
def a01(spark: SparkSession, folder: str) -> DataFrame:
    return tables.write_table(main_discussions(spark, folder), f"{shared_folder(spark)}/discussions", DISCUSSIONS)


@query("a02_sql_scan", MAIN + PER_REPO)
def a02(spark: SparkSession, folder: str) -> DataFrame:
    views.create_views(spark, *main(spark, folder))
    return spark.sql(PER_REPO)


@query("a03_joined_projection", MAIN + """
SELECT m.model_id, d.is_pull_request, d.status,
       CASE WHEN d.author IS NOT NULL THEN d.created_at END AS created_at, d.closed_at
FROM discussions d JOIN model_repos m ON m.id = d.repo_id""")  # fmt: skip
def a03(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder)
    as_text = F.when(F.col("author").isNotNull(), F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).otherwise("no time")
    return joins.joined_activity(discussions.withColumn("created_at", as_text), repos)


def _landed_models(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/models"
    # Counts are delivered as text; one line for each nation is cut off, another has a count that is no number.
    listed_models(spark, folder).withColumn("likes", F.col("likes").cast("string")).write.json(path)
    broken = "explode(array('{\"id\": \"' || n_name, '{\"id\": \"' || n_name || '\", \"tag\": \"t\", \"likes\": \"many\"}'))"
    table(spark, folder, "nation").selectExpr(f"{broken} AS line").write.text(f"{path}-broken")
    return landing.read_model_listings(spark, path, f"{path}-broken")


#: Records of a landing file: about a hundred megabytes of lines.
LANDED_RECORDS = 500_000


def _landed_discussions(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    # Files are compressed, and cut by records so that many tasks read them.
    files = listed_discussions(spark, folder).write.option("compression", "gzip").option("maxRecordsPerFile", LANDED_RECORDS)
    files.json(f"{base}/delivered")
    fetch_failures(spark, folder).write.json(f"{base}/failed")
    return landing.read_discussion_listings(spark, f"{base}/delivered", f"{base}/failed")


MODEL_ROWS = (
    f"WITH {LISTED_MODELS.replace('AS last_modified,', 'AS last_modified, n_regionkey,')}, rows AS ("
    "SELECT id AS model_id, tag, author, coalesce(likes, 0) AS likes, coalesce(downloads, 0) AS downloads, pipeline_tag,"
    f"{LISTED_MODEL_TIMES}, seq FROM listed_models)\n"
)


@query("a04_model_ingest", MODEL_ROWS + "SELECT * EXCLUDE (seq) FROM rows"
       " QUALIFY row_number() OVER (PARTITION BY tag ORDER BY downloads DESC, model_id ASC NULLS FIRST) <= 5")  # fmt: skip
def a04(spark: SparkSession, folder: str) -> DataFrame:
    readable, _ = landing.split_unreadable(_landed_models(spark, folder), landing.MODEL_COUNTS)
    return landing.top_model_rows(readable, n=5)


DISCUSSION_TIMES = """
  CASE WHEN l_linenumber <> 4 THEN l_shipdate END AS created_at,
  CASE WHEN l_linenumber < 3 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 14 HOURS END AS closed_at"""
DISCUSSION_ROWS = (
    f"WITH {LISTED_DISCUSSIONS}, rows AS (SELECT model_id, coalesce(num, 0) AS hf_discussion_num,"
    " coalesce(title, '') AS title, author, coalesce(is_pull_request, false) AS is_pull_request,"
    f" coalesce(status, 'open') AS status, {DISCUSSION_TIMES}, seq FROM listed_discussions)\n"
)


@query("a05_discussion_ingest", DISCUSSION_ROWS + "SELECT * EXCLUDE (seq) FROM rows")
def a05(spark: SparkSession, folder: str) -> DataFrame:
    delivered, _ = landing.split_errors(_landed_discussions(spark, folder))
    return landing.discussion_rows(delivered)


@query("a06_fetch_errors", "SELECT s_name AS model_id, s_name || ': 403 discussions disabled, nation ' || s_nationkey AS message"
       " FROM supplier WHERE s_acctbal < 0")  # fmt: skip
def a06(spark: SparkSession, folder: str) -> DataFrame:
    _, errors = landing.split_errors(_landed_discussions(spark, folder))
    return errors


@query("a07_enforced_schema", f"WITH {SPARSE_REPOS} SELECT id, model_id, tag, author, likes, downloads,"
       " CAST(NULL AS VARCHAR) AS pipeline_tag, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS last_modified"
       " FROM model_repos")  # fmt: skip
def a07(spark: SparkSession, folder: str) -> DataFrame:
    return enforce(sparse_repos(spark, folder).withColumn("extra", F.lit(1)), MODEL_REPOS)


# Stored repositories are suppliers; the batch lists one repository per order, many times each.
MODEL_BATCH = """
batch AS (
  SELECT 'Supplier#' || lpad(CAST(o_custkey + 50 AS VARCHAR), 9, '0') AS model_id, o_orderstatus AS tag,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS author,
         CAST(trunc(o_totalprice) AS BIGINT) AS likes, o_custkey AS downloads, CAST(NULL AS VARCHAR) AS pipeline_tag,
         o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS last_modified, o_orderkey AS seq
  FROM orders)"""


def model_batch(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "'Supplier#' || lpad(CAST(o_custkey + 50 AS STRING), 9, '0') AS model_id",
        "o_orderstatus AS tag",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS author",
        "CAST(o_totalprice AS BIGINT) AS likes",
        "o_custkey AS downloads",
        "CAST(NULL AS STRING) AS pipeline_tag",
        "o_orderdate AS created_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS last_modified",
        "o_orderkey AS seq",
    )


LATEST_MODELS = """
latest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY seq DESC) = 1)"""


@query("a08_upsert_models", f"""WITH {MAIN_REPOS}, {MODEL_BATCH}, {LATEST_MODELS}
SELECT m.id, l.* EXCLUDE (seq) FROM latest l JOIN model_repos m USING (model_id)
UNION ALL BY NAME
SELECT * FROM model_repos m WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.model_id = m.model_id)
UNION ALL BY NAME
SELECT (SELECT max(id) FROM model_repos) + row_number() OVER (ORDER BY md5(model_id), model_id) AS id, * EXCLUDE (seq)
FROM latest l WHERE NOT EXISTS (SELECT 1 FROM model_repos m WHERE l.model_id = m.model_id)""")  # fmt: skip
def a08(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.upsert_models(main_repos(spark, folder), model_batch(spark, folder), ["seq"])


# Stored discussions: one per supplier and order. The batch holds events, numbered by value, of
# suppliers known and unknown.
STORED_DISCUSSIONS = """
stored AS (
  SELECT min(l_orderkey * 8 + l_linenumber) AS id, l_suppkey AS repo_id, l_orderkey AS hf_discussion_num,
         'line ' || min(l_linenumber) AS title, max(l_returnflag) AS author, bool_or(l_returnflag = 'R') AS is_pull_request,
         CASE WHEN min(l_linestatus) = 'F' THEN 'closed' ELSE 'open' END AS status,
         min(l_shipdate) AS created_at, max(l_shipdate) AS closed_at
  FROM lineitem GROUP BY l_suppkey, l_orderkey)"""
EVENT_BATCH = """
batch AS (
  SELECT m.id AS repo_id, CAST(floor(e.value) AS BIGINT) AS hf_discussion_num, e.event_type AS title,
         CASE WHEN e.event_type = 'view' THEN NULL ELSE e.event_type END AS author, e.event_type = 'purchase' AS is_pull_request,
         CASE WHEN e.event_type = 'error' THEN 'closed' ELSE 'open' END AS status,
         e.ts AS created_at, CASE WHEN e.event_type = 'error' THEN e.ts END AS closed_at, e.event_id AS seq
  FROM events e JOIN model_repos m ON m.model_id = 'Supplier#' || lpad(CAST(e.user_id AS VARCHAR), 9, '0')),
latest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY repo_id, hf_discussion_num ORDER BY seq DESC) = 1)"""


def stored_discussions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey").alias("repo_id"), F.col("l_orderkey").alias("hf_discussion_num")
    )
    return rows.agg(
        F.expr("min(l_orderkey * 8 + l_linenumber) AS id"),
        F.expr("'line ' || min(l_linenumber) AS title"),
        F.expr("max(l_returnflag) AS author"),
        F.expr("bool_or(l_returnflag = 'R') AS is_pull_request"),
        F.expr("CASE WHEN min(l_linestatus) = 'F' THEN 'closed' ELSE 'open' END AS status"),
        F.expr("min(l_shipdate) AS created_at"),
        F.expr("max(l_shipdate) AS closed_at"),
    )


def event_batch(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "'Supplier#' || lpad(CAST(user_id AS STRING), 9, '0') AS model_id",
        "CAST(floor(value) AS BIGINT) AS hf_discussion_num",
        "event_type AS title",
        "CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS author",
        "event_type = 'purchase' AS is_pull_request",
        "CASE WHEN event_type = 'error' THEN 'closed' ELSE 'open' END AS status",
        "ts AS created_at",
        "CASE WHEN event_type = 'error' THEN ts END AS closed_at",
        "event_id AS seq",
    )


UPSERTED = f"WITH {MAIN_REPOS}, {STORED_DISCUSSIONS}, {EVENT_BATCH}\n"


@query("a09_upsert_discussions", UPSERTED + """
SELECT s.id, l.* EXCLUDE (seq) FROM latest l JOIN stored s USING (repo_id, hf_discussion_num)
UNION ALL BY NAME
SELECT * FROM stored s WHERE NOT EXISTS
  (SELECT 1 FROM latest l WHERE l.repo_id = s.repo_id AND l.hf_discussion_num = s.hf_discussion_num)
UNION ALL BY NAME
SELECT (SELECT max(id) FROM stored)
       + row_number() OVER (ORDER BY md5(repo_id || '/' || hf_discussion_num), repo_id, hf_discussion_num) AS id,
       * EXCLUDE (seq)
FROM latest l WHERE NOT EXISTS
  (SELECT 1 FROM stored s WHERE l.repo_id = s.repo_id AND l.hf_discussion_num = s.hf_discussion_num)""")  # fmt: skip
def a09(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.upsert_discussions(
        stored_discussions(spark, folder), main_repos(spark, folder), event_batch(spark, folder), ["seq"]
    )


@query("a09_touched_rows", UPSERTED + "SELECT count(*) AS touched_rows FROM batch")
def a09_touched(spark: SparkSession, folder: str) -> DataFrame:
    return upsert.touched_rows(event_batch(spark, folder), main_repos(spark, folder))


@query("c06_upsert_actions", UPSERTED + """
SELECT repo_id, hf_discussion_num, count(*) AS batch_rows,
       CASE WHEN EXISTS (SELECT 1 FROM stored s WHERE s.repo_id = b.repo_id AND s.hf_discussion_num = b.hf_discussion_num)
            THEN 'update' ELSE 'insert' END AS action
FROM batch b GROUP BY ALL""")  # fmt: skip
def c06(spark: SparkSession, folder: str) -> DataFrame:
    batch = joins.resolve_repo(event_batch(spark, folder), main_repos(spark, folder))
    return upsert.upsert_actions(stored_discussions(spark, folder), batch, ["repo_id", "hf_discussion_num"])


@query("a10_csv_export", MAIN + """
SELECT CAST(id AS VARCHAR) AS id, CAST(repo_id AS VARCHAR) AS repo_id, CAST(hf_discussion_num AS VARCHAR) AS hf_discussion_num,
       title, author, CAST(is_pull_request AS VARCHAR) AS is_pull_request, status,
       strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, strftime(closed_at, '%Y-%m-%dT%H:%M:%S.%f') AS closed_at
FROM discussions""")  # fmt: skip
def a10(spark: SparkSession, folder: str) -> DataFrame:
    """The exported text itself: read back without types."""
    path = f"{shared_folder(spark)}/csv"
    csv_files.export_csv(main_discussions(spark, folder), path)
    return spark.read.csv(path, header=True, escape='"', multiLine=True)


@query("a11_csv_import", f"WITH {MAIN_REPOS} SELECT * FROM model_repos")
def a11(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/csv"
    csv_files.export_csv(main_repos(spark, folder), path)
    return csv_files.import_csv(spark, path, MODEL_REPOS)


CLEAN_VIEW = """
SELECT d.id, d.repo_id, m.model_id, d.hf_discussion_num, d.title, d.author, d.is_pull_request,
       lower(trim(d.status)) AS status, lower(trim(d.status)) = 'closed' AS is_closed, d.created_at, d.closed_at,
       dayname(d.created_at) AS weekday_created, dayname(d.closed_at) AS weekday_closed
FROM discussions d JOIN model_repos m ON m.id = d.repo_id"""


@query("a12_replaced_views", f"WITH {SPARSE_REPOS}, {EVENT_DISCUSSIONS} {CLEAN_VIEW}")
def a12(spark: SparkSession, folder: str) -> DataFrame:
    """Views made over one pair of tables, then replaced by those over another."""
    views.create_views(spark, *main(spark, folder))
    views.create_views(spark, sparse_repos(spark, folder), event_discussions(spark, folder))
    return spark.table("v_discussions_clean")


CLEAN_MODELS = (
    MODEL_ROWS.rstrip()
    + f""", clean_models AS (
  SELECT {sql_strip("model_id")} AS model_id, {sql_strip("tag")} AS tag, nullif({sql_strip("author")}, '') AS author,
         greatest(likes, 0) AS likes, greatest(downloads, 0) AS downloads,
         nullif({sql_strip("pipeline_tag")}, '') AS pipeline_tag, created_at, last_modified, seq
  FROM rows WHERE model_id <> '' AND tag <> '')
"""
)
CLEAN_DISCUSSIONS = f"""clean_discussions AS (
  SELECT {sql_strip("model_id")} AS model_id, hf_discussion_num, {sql_strip("title")} AS title,
         nullif({sql_strip("author")}, '') AS author, is_pull_request,
         CASE WHEN lower({sql_strip("status")}) = 'closed' THEN 'closed' ELSE 'open' END AS status,
         created_at, closed_at, dayname(created_at) AS weekday
  FROM drows WHERE model_id <> '' AND hf_discussion_num IS NOT NULL)"""


NOTES = ("Suppliers stand for repositories.", "Line items stand for discussions.")


@query("a13_load_summary", CLEAN_MODELS.rstrip() + ", " + DISCUSSION_ROWS.replace("WITH", "", 1).replace("rows AS", "drows AS").rstrip()
       + f""", {CLEAN_DISCUSSIONS},
counts AS (
  SELECT 'models_seen' AS item, (SELECT count(*) FROM rows) AS n
  UNION ALL SELECT 'models_cleaned', (SELECT count(*) FROM clean_models)
  UNION ALL SELECT 'models_loaded', (SELECT count(*) FROM clean_models)
  UNION ALL SELECT 'discussions_seen', (SELECT count(*) FROM drows)
  UNION ALL SELECT 'discussions_cleaned', (SELECT count(*) FROM clean_discussions)
  UNION ALL SELECT 'discussions_loaded',
    (SELECT count(*) FROM clean_discussions WHERE model_id IN (SELECT model_id FROM clean_models))
  UNION ALL SELECT 'models_unreadable', (SELECT 2 * count(*) FROM nation)
  UNION ALL SELECT 'discussions_unreadable', 0)
SELECT 'count' AS section, item, CAST(n AS VARCHAR) AS value FROM counts
UNION ALL SELECT 'fetch_error', s_name, s_name || ': 403 discussions disabled, nation ' || s_nationkey
  FROM supplier WHERE s_acctbal < 0
UNION ALL SELECT 'unreadable_record', NULL, 'unreadable record: {{"id": "' || n_name FROM nation
UNION ALL SELECT 'unreadable_record', n_name, 'unusable likes: many' FROM nation
""".replace("{{", "{") + "".join(f"UNION ALL SELECT 'limitation', 'note_{i}', '{text}'\n" for i, text in enumerate(NOTES, 1)))  # fmt: skip
def a13(spark: SparkSession, folder: str) -> DataFrame:
    loaded = load(_landed_models(spark, folder), _landed_discussions(spark, folder), shared_folder(spark), notes=NOTES)
    return loaded.summary


# One report line per event, with one run for each of four backends.
BACKENDS = ("local", "container", "hosted", "cloud")


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    runs = ", ".join(
        f"named_struct('backend', '{b}', 'label', upper('{b}'), 'ok', event_type <> 'error' OR {i} = 0,"
        f" 'elapsed_seconds', value * {i + 1}, 'stdout_len', length(props), 'stderr_len', 0L,"
        f" 'notes', event_type, 'stderr_preview', '')"
        for i, b in enumerate(BACKENDS)
    )
    return table(spark, folder, "events").selectExpr(
        "array(named_struct('prompt', 'event ' || event_id, 'code_generation_seconds', value, 'code_chars',"
        f" length(props), 'runs', array({runs}))) AS prompts"
    )


def _landed_runs(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/runs"
    _reports(spark, folder).write.json(path)
    return run_log.read_run_log(spark, path, multi_line=False)


RUNS = (
    "WITH runs AS ("
    + " UNION ALL ".join(
        f"SELECT 'event ' || event_id AS prompt, value AS code_generation_seconds, length(props) AS code_chars,"
        f" '{b}' AS backend, '{b.upper()}' AS label, event_type <> 'error' OR {i} = 0 AS ok,"
        f" value * {i + 1} AS elapsed_seconds, length(props) AS stdout_len, CAST(0 AS BIGINT) AS stderr_len,"
        f" event_type AS notes, '' AS stderr_preview FROM events"
        for i, b in enumerate(BACKENDS)
    )
    + ")\n"
)


@query("a14_run_log", RUNS + "SELECT * FROM runs")
def a14(spark: SparkSession, folder: str) -> DataFrame:
    return run_log.flatten_runs(_landed_runs(spark, folder))


@query("a14_indented_reports", RUNS + "SELECT * FROM runs")
def a14_indented(spark: SparkSession, folder: str) -> DataFrame:
    """Reports with an indentation, cut by record as they are read."""
    record = F.to_json(F.get("prompts", F.lit(0)))
    inner = F.substring(record, F.lit(2), F.length(record) - 2)
    text = F.concat(F.lit('{\n  "prompts": [\n    {\n      '), inner, F.lit("\n    }\n  ]\n}"))
    path = f"{shared_folder(spark)}/reports"
    _reports(spark, folder).select(text).write.text(path)
    return run_log.runs_of(run_log.read_prompts(spark, path))


@query("d15_backend_summary", RUNS + "SELECT backend, count(*) AS runs, count(*) FILTER (WHERE ok) AS ok_runs,"
       " count(*) FILTER (WHERE ok) / count(*) AS ok_rate, round(avg(elapsed_seconds), 3) AS mean_elapsed_seconds"
       " FROM runs GROUP BY backend")  # fmt: skip
def d15(spark: SparkSession, folder: str) -> DataFrame:
    return run_log.backend_summary(run_log.flatten_runs(_landed_runs(spark, folder)))


# --- cleaning -----------------------------------------------------------------------------------


@query("b01_b04_clean_models", CLEAN_MODELS + "SELECT * EXCLUDE (seq) FROM clean_models")
def b01(spark: SparkSession, folder: str) -> DataFrame:
    """Required keys, stripping, optional strings, counts."""
    return cleaning.clean_models(landing.model_rows(listed_models(spark, folder)))


# Cleaning itself also takes null numbers, titles, flags and statuses, so it gets the listed values.
RAW_DISCUSSIONS = f"""WITH {LISTED_DISCUSSIONS}, drows AS (
  SELECT model_id, num AS hf_discussion_num, coalesce(title, '') AS title, author,
         coalesce(is_pull_request, false) AS is_pull_request, status, {DISCUSSION_TIMES} FROM listed_discussions),
{CLEAN_DISCUSSIONS}
"""


def raw_discussions(spark: SparkSession, folder: str) -> DataFrame:
    listed = listed_discussions(spark, folder)
    times = {c: parse_iso(F.col(c)) for c in ("created_at", "closed_at")}
    return listed.withColumnRenamed("num", "hf_discussion_num").withColumns(times).drop("fetch_error", "seq")


@query("b05_b11_clean_discussions", RAW_DISCUSSIONS + "SELECT * FROM clean_discussions")
def b05(spark: SparkSession, folder: str) -> DataFrame:
    """Required keys, status, weekday, title, pull-request flag."""
    return cleaning.clean_discussions(raw_discussions(spark, folder))


@query("b02_strip_documents", f"SELECT doc_id, {sql_strip('text')} AS stripped FROM"
       " (SELECT doc_id, chr(160) || chr(9) || text || chr(8195) || chr(28) || chr(133) AS text FROM documents)")  # fmt: skip
def b02(spark: SparkSession, folder: str) -> DataFrame:
    from repopulse.functions.text import strip

    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit(" \x1c\x85"))
    return table(spark, folder, "documents").select("doc_id", strip(padded).alias("stripped"))


@query("b07_listed_status", f"WITH {LISTED_DISCUSSIONS} SELECT status, count(*) AS row_count FROM"
       " (SELECT CASE WHEN lower(status) = 'closed' THEN 'closed' ELSE 'open' END AS status FROM listed_discussions) GROUP BY status")  # fmt: skip
def b07(spark: SparkSession, folder: str) -> DataFrame:
    listed = listed_discussions(spark, folder)
    return listed.groupBy(listed_status(F.col("status")).alias("status")).agg(F.count(F.lit(1)).alias("row_count"))


@query("b08_weekday_name", "SELECT event_id, dayname(ts) AS weekday FROM events")
def b08(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", weekday_name(F.col("ts")).alias("weekday"))


@query("b09_add_weekday", MAIN + "SELECT id, repo_id, hf_discussion_num, created_at, dayname(created_at) AS weekday FROM discussions")
def b09(spark: SparkSession, folder: str) -> DataFrame:
    rows = main_discussions(spark, folder, closed_at=False)
    return cleaning.add_weekday(rows.select("id", "repo_id", "hf_discussion_num", "created_at"))


@query("b12_iso_times", "SELECT event_id, CASE event_type WHEN 'view' THEN ts WHEN 'click' THEN ts - INTERVAL 150 MINUTES"
       " WHEN 'purchase' THEN date_trunc('minute', ts) WHEN 'error' THEN date_trunc('day', ts) END AS parsed FROM events")  # fmt: skip
def b12(spark: SparkSession, folder: str) -> DataFrame:
    text = F.expr(
        "CASE event_type WHEN 'view' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
        " WHEN 'click' THEN date_format(ts, \"yyyyMMdd'T'HHmmss.SSSSSS'+0230'\")"
        " WHEN 'purchase' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm\") WHEN 'error' THEN date_format(ts, 'yyyyMMdd')"
        " ELSE date_format(ts, 'yyyy-MM') END"
    )
    return table(spark, folder, "events").select("event_id", parse_iso(text).alias("parsed"))


@query("b13_clean_view", MAIN + CLEAN_VIEW)
def b13(spark: SparkSession, folder: str) -> DataFrame:
    return views.discussions_clean(*main(spark, folder))


@query("d06_summary_view", _with_totals(MAIN) + RATES.format(columns="model_id, tag, likes, downloads"))
def d06(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(views.discussion_summary(*main(spark, folder, closed_at=False)), "closure_rate")


@query("d07_weekday_view", MAIN + f"SELECT model_id, weekday_created AS weekday, count(*) AS discussion_count"
       f" FROM ({CLEAN_VIEW}) WHERE created_at IS NOT NULL GROUP BY ALL")  # fmt: skip
def d07(spark: SparkSession, folder: str) -> DataFrame:
    return views.discussions_by_weekday(*main(spark, folder, closed_at=False))


@query("b14_null_filters", MAIN + "SELECT id, created_at, closed_at FROM discussions"
       " WHERE created_at IS NOT NULL AND closed_at IS NOT NULL")  # fmt: skip
def b14(spark: SparkSession, folder: str) -> DataFrame:
    rows = main_discussions(spark, folder).select("id", "created_at", "closed_at")
    return rows.filter(F.col("created_at").isNotNull() & F.col("closed_at").isNotNull())


@query("b15_closed_only", MAIN + "SELECT id, repo_id, status FROM discussions WHERE status = 'closed'")
def b15(spark: SparkSession, folder: str) -> DataFrame:
    rows = main_discussions(spark, folder, closed_at=False).select("id", "repo_id", "status")
    return rows.filter(F.col("status") == "closed")


@query("b16_pull_requests", MAIN + "SELECT id, repo_id, is_pull_request FROM discussions WHERE is_pull_request")
def b16(spark: SparkSession, folder: str) -> DataFrame:
    return main_discussions(spark, folder, closed_at=False).select("id", "repo_id", "is_pull_request").filter("is_pull_request")


@query("b17_drop_nulls", MAIN + "SELECT id, author, created_at FROM discussions WHERE created_at IS NOT NULL")
def b17(spark: SparkSession, folder: str) -> DataFrame:
    return main_discussions(spark, folder, closed_at=False).select("id", "author", "created_at").dropna(subset=["created_at"])


@query("b20_b21_column_subset", MAIN + "SELECT repo_id, status AS state FROM discussions")
def b20(spark: SparkSession, folder: str) -> DataFrame:
    rows = main_discussions(spark, folder, closed_at=False).select("id", "repo_id", "status")
    return rows.drop("id").withColumnRenamed("status", "state")


# --- unions and repeated keys -------------------------------------------------------------------


@query("g01_concatenation", f"WITH {MAIN_REPOS}, {MODEL_BATCH} SELECT model_id, tag, likes FROM model_repos"
       " UNION ALL SELECT model_id, tag, likes FROM batch")  # fmt: skip
def g01(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("model_id", "tag", "likes")
    return landing.concatenate(main_repos(spark, folder).select(*columns), model_batch(spark, folder).select(*columns))


@query("g02_latest_per_key", f"WITH {MODEL_BATCH}, {LATEST_MODELS} SELECT * FROM latest")
def g02(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.latest_per_key(model_batch(spark, folder), ["model_id"], ["seq"])
