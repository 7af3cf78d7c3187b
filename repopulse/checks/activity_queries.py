"""Counts, windows, rankings and the fixed questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.checks.registry import query
from repopulse.checks.tables import (
    MAIN,
    ORPHANS,
    SPARSE,
    event_discussions,
    main_discussions,
    main_repos,
    sparse_repos,
    table,
)
from repopulse.operators import activity, joins, metrics, ranking, windows
from repopulse.plans import reports


def main(spark: SparkSession, folder: str, closed_at: bool = True) -> tuple[DataFrame, DataFrame]:
    return main_repos(spark, folder), main_discussions(spark, folder, closed_at)


def sparse(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return sparse_repos(spark, folder), event_discussions(spark, folder)


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# Exact half-up ratio with two digits on whole numbers p, q.
RATE = "CASE WHEN {q} = 0 THEN NULL ELSE CAST((200 * {p} + {q}) // (2 * {q}) AS DOUBLE) / 100.0::DOUBLE END"

TOTALS = """
totals AS (
  SELECT m.model_id, any_value(m.tag) AS tag, any_value(m.likes) AS likes, any_value(m.downloads) AS downloads,
         count(d.id) AS total_discussions,
         count(*) FILTER (WHERE d.status = 'closed') AS closed_discussions,
         count(*) FILTER (WHERE d.status = 'open') AS open_discussions
  FROM model_repos m LEFT JOIN discussions d ON d.repo_id = m.id GROUP BY m.model_id
)"""
RATES = "SELECT {columns}, total_discussions, closed_discussions, open_discussions, " + RATE.format(
    p="closed_discussions", q="total_discussions"
) + " AS closure_rate FROM totals"


def _with_totals(prefix: str) -> str:
    return f"{prefix.rstrip()}, {TOTALS}\n"


# --- joins --------------------------------------------------------------------------------------


@query(
    "c01_inner_join",
    MAIN + "SELECT d.id, d.repo_id, d.hf_discussion_num, d.title, d.author, d.is_pull_request, d.status,"
    " d.created_at, m.model_id FROM discussions d JOIN model_repos m ON m.id = d.repo_id",
)
def c01(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    return joins.with_repo(discussions, repos, "model_id")


@query(
    "c02_left_join_keeps_quiet_repos",
    _with_totals(SPARSE) + RATES.format(columns="model_id"),
)
def c02(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(activity.closure_rates(*sparse(spark, folder)), "closure_rate")


@query(
    "c03_left_join_to_aggregate",
    _with_totals(SPARSE)
    + "SELECT model_id, tag, likes, downloads, total_discussions, closed_discussions, open_discussions FROM totals",
)
def c03(spark: SparkSession, folder: str) -> DataFrame:
    return activity.with_totals(*sparse(spark, folder), "model_id", "tag", "likes", "downloads")


NAMED_EVENTS = (
    ORPHANS.rstrip()
    + """, batch AS (
  SELECT 'Supplier#' || lpad(CAST(repo_id AS VARCHAR), 9, '0') AS model_id, hf_discussion_num, status, created_at
  FROM discussions)
"""
)


def named_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events keyed by repository name, as a batch is before loading."""
    return event_discussions(spark, folder).selectExpr(
        "'Supplier#' || lpad(CAST(repo_id AS STRING), 9, '0') AS model_id", "hf_discussion_num", "status", "created_at"
    )


@query(
    "c04_resolve_repo",
    NAMED_EVENTS + "SELECT m.id AS repo_id, b.hf_discussion_num, b.status, b.created_at"
    " FROM batch b JOIN model_repos m ON m.model_id = b.model_id",
)
def c04(spark: SparkSession, folder: str) -> DataFrame:
    return joins.resolve_repo(named_events(spark, folder), main_repos(spark, folder))


@query(
    "c05_orphans",
    NAMED_EVENTS + "SELECT b.model_id, count(*) AS skipped_rows FROM batch b"
    " WHERE NOT EXISTS (SELECT 1 FROM model_repos m WHERE m.model_id = b.model_id) GROUP BY b.model_id",
)
def c05(spark: SparkSession, folder: str) -> DataFrame:
    return joins.orphans(named_events(spark, folder), main_repos(spark, folder))


@query(
    "c07_denormalised",
    MAIN + "SELECT d.id AS id_disc, d.repo_id, d.hf_discussion_num, d.title, d.author AS author_disc, d.is_pull_request,"
    " d.status, d.created_at AS created_at_disc, d.closed_at, m.id AS id_model, m.model_id, m.tag,"
    " m.author AS author_model, m.likes, m.downloads, m.pipeline_tag, m.created_at AS created_at_model, m.last_modified"
    " FROM discussions d JOIN model_repos m ON m.id = d.repo_id",
)
def c07(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder)
    return joins.denormalised(discussions, repos)


# --- counts -------------------------------------------------------------------------------------

PER_REPO = (
    "SELECT m.model_id, count(d.id) AS discussion_count FROM model_repos m JOIN discussions d ON d.repo_id = m.id"
    " GROUP BY m.model_id"
)
PER_REPO_WEEKDAY = (
    "SELECT m.model_id, dayname(d.created_at) AS weekday, count(*) AS discussion_count"
    " FROM model_repos m JOIN discussions d ON d.repo_id = m.id WHERE d.created_at IS NOT NULL"
    " GROUP BY m.model_id, dayname(d.created_at)"
)
CREATED_WEEKDAY = (
    "SELECT dayname(created_at) AS weekday, count(*) AS total_discussions FROM discussions"
    " WHERE created_at IS NOT NULL GROUP BY ALL"
)
CLOSED_WEEKDAY = (
    "SELECT dayname(closed_at) AS weekday, count(*) AS closed_discussions FROM discussions"
    " WHERE status = 'closed' AND closed_at IS NOT NULL GROUP BY ALL"
)
DAILY = (
    "SELECT m.model_id, CAST(d.created_at AS DATE) AS day, count(*) AS daily_discussions"
    " FROM model_repos m JOIN discussions d ON d.repo_id = m.id WHERE d.created_at IS NOT NULL GROUP BY ALL"
)


@query("d01_discussions_per_repo", MAIN + PER_REPO)
def d01(spark: SparkSession, folder: str) -> DataFrame:
    return reports.most_discussed(*main(spark, folder, closed_at=False))


@query("d02_repo_weekday", MAIN + PER_REPO_WEEKDAY)
def d02(spark: SparkSession, folder: str) -> DataFrame:
    return reports.repo_weekday_table(*main(spark, folder, closed_at=False))


@query("d03_created_weekday", MAIN + CREATED_WEEKDAY)
def d03(spark: SparkSession, folder: str) -> DataFrame:
    return reports.created_weekdays(*main(spark, folder, closed_at=False))


@query("d04_closed_weekday", MAIN + CLOSED_WEEKDAY)
def d04(spark: SparkSession, folder: str) -> DataFrame:
    return reports.closed_weekdays(*main(spark, folder))


@query("d05_closure_rate", _with_totals(MAIN) + RATES.format(columns="model_id"))
def d05(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(reports.closure_rates(*main(spark, folder, closed_at=False)), "closure_rate")


@query("d08_daily_totals", MAIN + "SELECT CAST(created_at AS DATE) AS day, count(*) AS total_discussions"
       " FROM discussions WHERE created_at IS NOT NULL GROUP BY ALL")  # fmt: skip
def d08(spark: SparkSession, folder: str) -> DataFrame:
    return reports.total_over_time(*main(spark, folder, closed_at=False))


@query("d09_daily_per_repo", MAIN + DAILY)
def d09(spark: SparkSession, folder: str) -> DataFrame:
    return reports.daily_per_repo(*main(spark, folder, closed_at=False))


@query("d10_conditional_counts", MAIN + "SELECT repo_id, count(*) AS total_discussions,"
       " CAST(sum(CASE WHEN status = 'closed' THEN 1 ELSE 0 END) AS BIGINT) AS closed_discussions,"
       " CAST(sum(CASE WHEN status = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS open_discussions"
       " FROM discussions GROUP BY repo_id")  # fmt: skip
def d10(spark: SparkSession, folder: str) -> DataFrame:
    return activity.repo_totals(main_discussions(spark, folder, closed_at=False))


@query("d11_bounds", _with_totals(MAIN) + "SELECT min(downloads) AS downloads_min, min(likes) AS likes_min,"
       " min(total_discussions) AS total_discussions_min, max(downloads) AS downloads_max, max(likes) AS likes_max,"
       " max(total_discussions) AS total_discussions_max FROM totals")  # fmt: skip
def d11(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    return metrics.bounds(activity.with_totals(repos, discussions, "downloads", "likes"), *metrics.SCORED)


@query("d12_closure_ratio", _with_totals(SPARSE) + "SELECT model_id, CASE WHEN total_discussions > 0"
       " THEN round_even(CAST(closed_discussions AS DOUBLE) / total_discussions, 3) END AS closure_rate FROM totals")  # fmt: skip
def d12(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.engagement(*sparse(spark, folder)).select("model_id", "closure_rate")


@query("d13_closed_per_repo_day", MAIN + "SELECT m.model_id, CAST(d.closed_at AS DATE) AS day,"
       " count(*) AS daily_discussions FROM model_repos m JOIN discussions d ON d.repo_id = m.id"
       " WHERE d.closed_at IS NOT NULL GROUP BY ALL")  # fmt: skip
def d13(spark: SparkSession, folder: str) -> DataFrame:
    return activity.daily_per_repo(*main(spark, folder), "closed_at")


@query("d14_rows_by_tag", MAIN + "SELECT tag, count(*) AS row_count FROM model_repos GROUP BY tag")
def d14_tag(spark: SparkSession, folder: str) -> DataFrame:
    return activity.row_counts(main_repos(spark, folder), "tag")


@query("d14_rows_by_status", MAIN + "SELECT status, count(*) AS row_count FROM discussions GROUP BY status")
def d14_status(spark: SparkSession, folder: str) -> DataFrame:
    return activity.row_counts(main_discussions(spark, folder, closed_at=False), "status")


# --- windows and scores -------------------------------------------------------------------------

WITH_DAILY = f"{MAIN.rstrip()}, daily AS ({DAILY})\n"
SPIKES = """
, averaged AS (
  SELECT *, avg(daily_discussions) OVER (PARTITION BY model_id ORDER BY {order} {frame}) AS mean FROM daily)
SELECT model_id, day, daily_discussions, round_even(mean, 2) AS rolling_avg,
       round_even(daily_discussions / mean, 2) AS spike_ratio
FROM averaged WHERE daily_discussions >= {floor} AND daily_discussions / mean >= {times}"""


@query("w01_rolling_average", WITH_DAILY + "SELECT model_id, day, daily_discussions, avg(daily_discussions) OVER"
       " (PARTITION BY model_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg FROM daily")  # fmt: skip
def w01(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rolling_average(*main(spark, folder, closed_at=False))


@query("w02_spikes", WITH_DAILY.rstrip()
       + SPIKES.format(order="day", frame="ROWS BETWEEN 6 PRECEDING AND CURRENT ROW", floor=3, times=2))
def w02(spark: SparkSession, folder: str) -> DataFrame:
    return reports.spikes(*main(spark, folder, closed_at=False))


@query("w02_spikes_settings", WITH_DAILY.rstrip()
       + SPIKES.format(order="day", frame="ROWS BETWEEN 20 PRECEDING AND CURRENT ROW", floor=2, times=1.5))
def w02_settings(spark: SparkSession, folder: str) -> DataFrame:
    return reports.spikes(*main(spark, folder, closed_at=False), window=21, multiplier=1.5, min_daily=2)


@query("w02_spikes_calendar", WITH_DAILY.rstrip() + SPIKES.format(
    order="day", frame="RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW", floor=2, times=1.5))
def w02_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return windows.spikes(*main(spark, folder, closed_at=False), multiplier=1.5, min_daily=2, calendar=True)


def _scaled(column: str) -> str:
    low, high = f"(SELECT min({column}) FROM totals)", f"(SELECT max({column}) FROM totals)"
    return (
        f"CASE WHEN {high} = {low} THEN 0.0::DOUBLE"
        f" ELSE ({column}::DOUBLE - {low}::DOUBLE) / ({high}::DOUBLE - {low}::DOUBLE) END"
    )


ENGAGEMENT = f"""
, scaled AS (
  SELECT *, {_scaled("downloads")} AS norm_downloads, {_scaled("likes")} AS norm_likes,
         {_scaled("total_discussions")} AS norm_discussions,
         CASE WHEN total_discussions > 0
              THEN round_even(CAST(closed_discussions AS DOUBLE) / total_discussions, 3) END AS closure_rate
  FROM totals),
engagement AS (
  SELECT *, (norm_downloads + norm_likes + norm_discussions) / 3 AS engagement_score FROM scaled)
"""


@query("w03_engagement", _with_totals(MAIN).rstrip() + ENGAGEMENT + "SELECT * FROM engagement")
def w03(spark: SparkSession, folder: str) -> DataFrame:
    return reports.engagement(*main(spark, folder, closed_at=False))


@query("w03_engagement_quiet_repos", _with_totals(SPARSE).rstrip() + ENGAGEMENT + "SELECT * FROM engagement")
def w03_sparse(spark: SparkSession, folder: str) -> DataFrame:
    return reports.engagement(*sparse(spark, folder))


@query("w04_top_per_tag", SPARSE + "SELECT id, model_id, tag, author, likes, downloads FROM model_repos"
       " QUALIFY row_number() OVER (PARTITION BY tag ORDER BY downloads DESC, model_id) <= 5")  # fmt: skip
def w04(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_listings(sparse_repos(spark, folder), n=5)


SHARE = (
    f"SELECT model_id, discussion_count, discussion_count * 100.0::DOUBLE / (sum(discussion_count) OVER ())::DOUBLE"
    f" AS percent FROM ({PER_REPO})"
)


@query("w05_share_of_total", MAIN + SHARE)
def w05(spark: SparkSession, folder: str) -> DataFrame:
    return reports.share_per_repo(*main(spark, folder, closed_at=False))


# --- order, top-k, headline ---------------------------------------------------------------------


@query("f01_top_repos", MAIN + PER_REPO + " ORDER BY discussion_count DESC, model_id LIMIT 20")
def f01(spark: SparkSession, folder: str) -> DataFrame:
    return reports.most_discussed(*main(spark, folder, closed_at=False)).limit(20)


@query("f02_best_closure_rates", _with_totals(SPARSE) + RATES.format(columns="model_id")
       + " ORDER BY closure_rate DESC NULLS LAST, model_id LIMIT 200")
def f02(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(reports.closure_rates(*sparse(spark, folder)).limit(200), "closure_rate")


@query("f03_calendar_order", MAIN + "SELECT weekday, CAST(row_number() OVER (ORDER BY w) AS INTEGER) AS place,"
       " total_discussions FROM (SELECT dayname(created_at) AS weekday, isodow(created_at) AS w, count(*) AS total_discussions"
       " FROM discussions WHERE created_at IS NOT NULL GROUP BY ALL)")  # fmt: skip
def f03(spark: SparkSession, folder: str) -> DataFrame:
    counts = activity.created_by_weekday(main_discussions(spark, folder, closed_at=False))
    return counts.orderBy("weekday_order").select("weekday", (F.col("weekday_order") + 1).alias("place"), "total_discussions")


@query("f04_first_repo_days", MAIN + DAILY + " ORDER BY model_id, day LIMIT 50")
def f04(spark: SparkSession, folder: str) -> DataFrame:
    return reports.daily_per_repo(*main(spark, folder, closed_at=False)).limit(50)


TOP_COLUMNS = "model_id, tag, downloads, likes, total_discussions, closure_rate, engagement_score"


@query("f05_top_by_engagement", _with_totals(MAIN).rstrip() + ENGAGEMENT
       + f"SELECT {TOP_COLUMNS} FROM engagement ORDER BY engagement_score DESC, model_id LIMIT 10")
def f05(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.top_by_engagement(*main(spark, folder, closed_at=False))


@query("f05_top_25_by_engagement", _with_totals(SPARSE).rstrip() + ENGAGEMENT
       + f"SELECT {TOP_COLUMNS} FROM engagement ORDER BY engagement_score DESC, model_id LIMIT 25")
def f05_25(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.top_by_engagement(*sparse(spark, folder), n=25)


@query(
    "f06_headline",
    _with_totals(MAIN).rstrip()
    + f""", rates AS ({RATES.format(columns="model_id")}),
top AS (SELECT * FROM rates WHERE total_discussions > 0 ORDER BY total_discussions DESC, model_id LIMIT 1),
best AS (SELECT * FROM rates WHERE closure_rate IS NOT NULL ORDER BY closure_rate DESC, model_id LIMIT 1),
created AS (SELECT dayname(created_at) AS w, count(*) AS n FROM discussions WHERE created_at IS NOT NULL
            GROUP BY dayname(created_at), isodow(created_at) ORDER BY n DESC, isodow(created_at) LIMIT 1),
closed AS (SELECT dayname(closed_at) AS w, count(*) AS n FROM discussions
           WHERE status = 'closed' AND closed_at IS NOT NULL
           GROUP BY dayname(closed_at), isodow(closed_at) ORDER BY n DESC, isodow(closed_at) LIMIT 1)
SELECT top.model_id AS busiest_repo, top.total_discussions AS busiest_repo_discussions,
       created.w AS busiest_created_weekday, created.n AS busiest_created_count,
       closed.w AS busiest_closed_weekday, closed.n AS busiest_closed_count,
       best.model_id AS best_closure_repo, best.closure_rate AS best_closure_rate
FROM top, created, closed, best""",
)
def f06(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(metrics.headline(*main(spark, folder)), "best_closure_rate")


# --- the fixed questions ------------------------------------------------------------------------


def _question(name: str, report: str, sql: str, closed_at: bool) -> None:
    @query(name, sql)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return reports.REPORTS[report](*main(spark, folder, closed_at))


_question("l01_most_discussed_repo", "most_discussed_repo",
          MAIN + PER_REPO + " ORDER BY discussion_count DESC, model_id LIMIT 1", False)
_question("l02_repo_weekday_table", "repo_weekday_table", MAIN + PER_REPO_WEEKDAY, False)
_question("l03_busiest_created_weekday", "busiest_created_weekday",
          MAIN + "SELECT weekday, total_discussions FROM (SELECT dayname(created_at) AS weekday, isodow(created_at) AS w,"
          " count(*) AS total_discussions FROM discussions WHERE created_at IS NOT NULL GROUP BY ALL)"
          " ORDER BY total_discussions DESC, w LIMIT 1", False)  # fmt: skip
_question("l04_busiest_closed_weekday", "busiest_closed_weekday",
          MAIN + "SELECT weekday, closed_discussions FROM (SELECT dayname(closed_at) AS weekday, isodow(closed_at) AS w,"
          " count(*) AS closed_discussions FROM discussions WHERE status = 'closed' AND closed_at IS NOT NULL GROUP BY ALL)"
          " ORDER BY closed_discussions DESC, w LIMIT 1", True)  # fmt: skip
_question("l05_total_over_time", "total_over_time",
          MAIN + "SELECT CAST(created_at AS DATE) AS day, count(*) AS total_discussions FROM discussions"
          " WHERE created_at IS NOT NULL GROUP BY ALL", False)  # fmt: skip
_question("l06_share_per_repo", "share_per_repo", MAIN + SHARE, False)
_question("l07_likes_per_repo", "likes_per_repo", MAIN + "SELECT model_id, likes FROM model_repos", False)
_question("l08_downloads_per_repo", "downloads_per_repo", MAIN + "SELECT model_id, downloads FROM model_repos", False)
_question("l09_closed_per_week", "closed_per_week",
          MAIN + "SELECT CAST(date_trunc('week', closed_at) AS DATE) AS week, count(*) AS closed_discussions"
          " FROM discussions WHERE status = 'closed' AND closed_at IS NOT NULL GROUP BY ALL", True)  # fmt: skip
_question("l10_open_versus_closed", "open_versus_closed",
          _with_totals(MAIN) + "SELECT model_id, 'open' AS status, open_discussions AS discussion_count FROM totals"
          " UNION ALL SELECT model_id, 'closed', closed_discussions FROM totals", False)  # fmt: skip


@query(
    "l02_repo_weekday_grid",
    MAIN + "SELECT m.model_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE isodow(d.created_at) = {i}) AS \"{name}\""
        for i, name in enumerate(("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"), 1)
    )
    + " FROM model_repos m JOIN discussions d ON d.repo_id = m.id WHERE d.created_at IS NOT NULL GROUP BY m.model_id",
)
def l02_grid(spark: SparkSession, folder: str) -> DataFrame:
    return reports.repo_weekday_grid(*main(spark, folder, closed_at=False))


# --- statements of the documentation ------------------------------------------------------------


@query("l15_weekly_closure_rate", MAIN + "SELECT *, " + RATE.format(p="closed_discussions", q="total_discussions")
       + " AS closure_rate FROM (SELECT CAST(date_trunc('week', created_at) AS DATE) AS week, count(*) AS total_discussions,"
       " count(*) FILTER (WHERE status = 'closed') AS closed_discussions"
       " FROM discussions WHERE created_at IS NOT NULL GROUP BY ALL)")  # fmt: skip
def l15(spark: SparkSession, folder: str) -> DataFrame:
    return as_double(activity.weekly_closure_rate(main_discussions(spark, folder, closed_at=False)), "closure_rate")


@query("l16_popularity_correlation", _with_totals(SPARSE)
       + "SELECT round(corr(downloads::DOUBLE, total_discussions::DOUBLE), 6) AS correlation, count(*) AS repos FROM totals")
def l16(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.popularity_correlation(*sparse(spark, folder))
    return found.withColumn("correlation", F.round("correlation", 6))


@query("l17_concentration", MAIN + f"""SELECT rank, model_id, discussion_count, cumulative_count,
  cumulative_count * 100.0::DOUBLE / total::DOUBLE AS cumulative_percent
FROM (SELECT CAST(row_number() OVER o AS INTEGER) AS rank, model_id, discussion_count,
             CAST(sum(discussion_count) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_count,
             sum(discussion_count) OVER () AS total
      FROM ({PER_REPO}) WINDOW o AS (ORDER BY discussion_count DESC, model_id))
WHERE rank <= 4""")  # fmt: skip
def l17(spark: SparkSession, folder: str) -> DataFrame:
    return activity.concentration(*main(spark, folder, closed_at=False))


@query("g03_repeated_keys", "SELECT l_suppkey AS repo_id, l_orderkey AS hf_discussion_num, count(*) - 1 AS extra_rows"
       " FROM lineitem GROUP BY ALL HAVING count(*) > 1")  # fmt: skip
def g03_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").selectExpr("l_suppkey AS repo_id", "l_orderkey AS hf_discussion_num")
    counts = rows.groupBy("repo_id", "hf_discussion_num").agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
    return counts.filter(F.col("extra_rows") > 0)
