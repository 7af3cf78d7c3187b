"""Forecasts. The additive model is checked by the conditions of its optimum and by lines; all others by their values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.checks.activity_queries import main
from repopulse.checks.registry import query
from repopulse.checks.tables import EVENT_DISCUSSIONS, MAIN, SPARSE, SPARSE_REPOS, event_discussions, sparse_repos, table
from repopulse.operators import forecast
from repopulse.plans import reports

SERIES = """, points AS (
  SELECT m.model_id, CAST(d.{date} AS DATE) AS day, CAST(count(*) AS DOUBLE) AS y
  FROM model_repos m JOIN discussions d ON d.repo_id = m.id WHERE d.{date} IS NOT NULL AND {keep} GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY day) AS i, count(*) OVER (PARTITION BY model_id) AS n
  FROM points)"""

HOLT = (
    SERIES
    + """, states AS (
  SELECT model_id, i, n, day, y AS level, 0.0::DOUBLE AS trend FROM numbered WHERE i = 1 AND n >= 3
  UNION ALL
  SELECT p.model_id, p.i, p.n, p.day, (s.level + s.trend) + {alpha}::DOUBLE * (p.y - (s.level + s.trend)),
         s.trend + {beta}::DOUBLE * (p.y - (s.level + s.trend))
  FROM states s JOIN numbered p ON p.model_id = s.model_id AND p.i = s.i + 1)
SELECT model_id, 'actual' AS kind, day, CAST(NULL AS INTEGER) AS step, y AS value FROM numbered WHERE n >= 3
UNION ALL
SELECT model_id, 'forecast', day + CAST(h AS INTEGER), CAST(h AS INTEGER), level + h * trend
FROM states, range(1, 8) t(h) WHERE i = n"""
)


def _holt_sql(prefix: str, keep: str, alpha: float = 0.5, beta: float = 0.1) -> str:
    return prefix.replace("WITH", "WITH RECURSIVE", 1).rstrip() + HOLT.format(date="created_at", keep=keep, alpha=alpha, beta=beta)


def events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return sparse_repos(spark, folder), event_discussions(spark, folder)


@query("j04_holt_fixed_events", _holt_sql(SPARSE, "true", 0.3, 0.05))
def j04_events(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = events(spark, folder)
    return forecast.holt_fixed(forecast.daily_series(repos, forecast.created(discussions)), 0.3, 0.05)


@query("j05_holt_fixed_pull_requests", _holt_sql(MAIN, "is_pull_request"))
def j05(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    return forecast.holt_fixed(forecast.daily_series(repos, forecast.pull_requests(discussions)), 0.5, 0.1)


@query("j06_holt_fixed_commits", _holt_sql(MAIN, "true"))
def j06(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    return forecast.holt_fixed(forecast.daily_series(repos, forecast.created(discussions)), 0.5, 0.1)


# The search for smoothing parameters: the error of every cell of a grid by the same recursion, which carries the
# constant and the two coefficients of the start values; then grids around the best cell. Grids as in functions/series.
PASS = """, states{k} AS (
  SELECT model_id, n, a, s, 0::BIGINT AS i, a::DOUBLE / 1000 AS alpha, a::DOUBLE / 1000 * (s::DOUBLE / 1000) AS beta,
         0.0::DOUBLE AS lc, 1.0::DOUBLE AS ll, 0.0::DOUBLE AS lb, 0.0::DOUBLE AS tc, 0.0::DOUBLE AS tl, 1.0::DOUBLE AS tb,
         0.0::DOUBLE AS rr, 0.0::DOUBLE AS rp, 0.0::DOUBLE AS rq, 0.0::DOUBLE AS pp, 0.0::DOUBLE AS pq, 0.0::DOUBLE AS qq
  FROM cells{k}
  UNION
  SELECT model_id, n, a, s, i, alpha, beta, e + alpha * r, p - alpha * p, q - alpha * q, tc + beta * r, tl - beta * p, tb - beta * q,
         rr + r * r, rp + r * p, rq + r * q, pp + p * p, pq + p * q, qq + q * q
  FROM (
    SELECT t.* EXCLUDE (i), v.i, lc + tc AS e, ll + tl AS p, lb + tb AS q, v.y - (lc + tc) AS r
    FROM states{k} t JOIN numbered v ON v.model_id = t.model_id AND v.i = t.i + 1)),
starts{k} AS (
  SELECT *, CASE WHEN flat THEN y1 - (y2 - y1) ELSE (rp * qq - rq * pq) / det END AS level0,
         CASE WHEN flat THEN y2 - y1 ELSE (rq * pp - rp * pq) / det END AS trend0
  FROM (SELECT *, pp * qq - pq * pq AS det, pp * qq - pq * pq <= 1e-12::DOUBLE * pp * qq AS flat FROM states{k} WHERE i = n)
  JOIN firsts USING (model_id)),
best{k} AS (
  SELECT * FROM starts{k}
  QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY round(greatest(rr - 2 * (level0 * rp + trend0 * rq)
    + level0 * level0 * pp + 2 * level0 * trend0 * pq + trend0 * trend0 * qq, 0), 6), a, s) = 1)"""

SEARCH = (
    SERIES
    + """, firsts AS (
  SELECT model_id, max(y) FILTER (WHERE i = 1) AS y1, max(y) FILTER (WHERE i = 2) AS y2, max(day) AS last FROM numbered GROUP BY model_id),
cells1 AS (
  SELECT model_id, n, a, s FROM numbered, range(50, 1000, 100) x(a), range(50, 1000, 100) y(s) WHERE i = 1 AND n >= 3)"""
    + PASS.format(k=1)
    + "".join(
        f""", cells{k} AS (
  SELECT model_id, n, a + {step} * da AS a, s + {step} * ds AS s FROM best{k - 1}, range(-4, 5) x(da), range(-4, 5) y(ds))"""
        + PASS.format(k=k)
        for k, step in ((2, 10), (3, 1))
    )
    + """
SELECT model_id, 'actual' AS kind, day, CAST(NULL AS INTEGER) AS step, y AS value FROM numbered WHERE n >= 3
UNION ALL
SELECT model_id, 'forecast', last + CAST(h AS INTEGER), CAST(h AS INTEGER),
       round(lc + ll * level0 + lb * trend0 + h * (tc + tl * level0 + tb * trend0), 6)
FROM best3, range(1, 8) t(h)"""
)


def _search_sql(prefix: str, keep: str) -> str:
    # Only the last state of a cell is kept on the way.
    keyed = SEARCH
    for k in (1, 2, 3):
        keyed = keyed.replace(f"states{k} AS (", f"states{k} USING KEY (model_id, a, s) AS (")
    return prefix.replace("WITH", "WITH RECURSIVE", 1).rstrip() + keyed.replace("{date}", "created_at").replace("{keep}", keep)


def _rounded(found: DataFrame, digits: int = 6) -> DataFrame:
    return found.withColumn("value", F.round("value", digits))


@query("j04_holt_forecast", _search_sql(SPARSE, "true"))
def j04(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.commit_forecast(*events(spark, folder)))


@query("l13_pull_request_forecast", _search_sql(MAIN, "is_pull_request"))
def l13(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.pull_request_forecast(*main(spark, folder, closed_at=False)))


@query("l14_commit_forecast", _search_sql(MAIN, "true"))
def l14(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.commit_forecast(*main(spark, folder, closed_at=False)))


@query("j01_additive_forecast")
def j01(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = events(spark, folder)
    return forecast.additive_forecast(forecast.daily_series(repos, forecast.created(discussions)))


# A fit is right if no condition of its optimum is violated: one row for each series, with the largest violation.
OPTIMUM = SERIES + """
SELECT model_id, CAST(n AS INTEGER) AS points, 0.0::DOUBLE AS violation, 'ok' AS status FROM numbered WHERE i = 1 AND n >= 2"""


def _optimum(series: DataFrame) -> DataFrame:
    fits = forecast.additive_fits(series.where(F.size("points") >= 2))
    return fits.select("model_id", F.size("points").alias("points"), F.round("violation", 6).alias("violation"), "status")


@query("j01_additive_optimum", SPARSE.rstrip() + OPTIMUM.format(date="created_at", keep="true"))
def j01_optimum(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = events(spark, folder)
    return _optimum(forecast.daily_series(repos, forecast.created(discussions)))


@query("l11_created_optimum", MAIN.rstrip() + OPTIMUM.format(date="created_at", keep="true"))
def l11_optimum(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    return _optimum(forecast.daily_series(repos, forecast.created(discussions)))


@query("l12_closed_optimum", MAIN.rstrip() + OPTIMUM.format(date="closed_at", keep="status = 'closed'"))
def l12_optimum(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder)
    return _optimum(forecast.daily_series(repos, forecast.closed(discussions)))


# The days of the tables with counts on a line: the forecast has to continue it.
LINES = SERIES + """, lines AS (
  SELECT model_id, day, n, min(day) OVER (PARTITION BY model_id) AS first, max(day) OVER (PARTITION BY model_id) AS last FROM numbered),
days AS (
  SELECT model_id, 'actual' AS kind, day, CAST(NULL AS INTEGER) AS step, first FROM lines WHERE n >= 2
  UNION ALL SELECT model_id, 'forecast', day, 0, first FROM lines WHERE n >= 2
  UNION ALL SELECT model_id, 'forecast', last + CAST(h AS INTEGER), CAST(h AS INTEGER), first FROM lines, range(1, 15) r(h)
            WHERE n >= 2 AND day = last)
SELECT model_id, kind, day, step, 5.0::DOUBLE + 2 * (day - first) AS value FROM days"""


@query("j01_additive_on_lines", MAIN.rstrip() + LINES.format(date="created_at", keep="true"))
def j01_lines(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    series = forecast.daily_series(repos, forecast.created(discussions))
    on_line = F.transform(
        "points", lambda p: F.struct(p["day"].alias("day"), (5.0 + 2 * F.datediff(p["day"], F.element_at("points", 1)["day"])).alias("value"))
    )
    return _rounded(forecast.additive_forecast(series.withColumn("points", on_line)), 3)


@query("l11_created_forecast")
def l11(spark: SparkSession, folder: str) -> DataFrame:
    return reports.created_forecast(*main(spark, folder, closed_at=False))


@query("l12_closed_forecast")
def l12(spark: SparkSession, folder: str) -> DataFrame:
    return reports.closed_forecast(*main(spark, folder))


LINE = (
    SERIES
    + """, timed AS (
  SELECT *, CAST(day - first_value(day) OVER (PARTITION BY model_id ORDER BY day) AS DOUBLE) AS t,
         isodow(day) AS w FROM numbered WHERE n >= 2),
sums AS (
  SELECT model_id, max(day) AS last, min(day) AS first, count(*)::DOUBLE AS n, sum(t) AS t, sum(y) AS y, sum(t * t) AS tt,
         sum(t * y) AS ty FROM timed GROUP BY model_id),
lines AS (SELECT *, (n * ty - t * y) / (n * tt - t * t) AS slope FROM sums),
based AS (SELECT *, (y - slope * t) / n AS base FROM lines),
seasons AS (
  SELECT p.model_id, p.w, (sum(p.y) - any_value(b.base) * count(*) - any_value(b.slope) * sum(p.t)) / count(*) AS season
  FROM timed p JOIN based b USING (model_id) GROUP BY p.model_id, p.w),
days AS (
  SELECT model_id, day, 0 AS step FROM timed
  UNION ALL SELECT model_id, last + CAST(h AS INTEGER), CAST(h AS INTEGER) FROM based, range(1, 15) r(h))
SELECT model_id, 'actual' AS kind, day, CAST(NULL AS INTEGER) AS step, y AS value FROM timed
UNION ALL
SELECT d.model_id, 'forecast', d.day, d.step,
       round(b.base + b.slope * (d.day - b.first) + coalesce(s.season, 0), 6)
FROM days d JOIN based b ON b.model_id = d.model_id
LEFT JOIN seasons s ON s.model_id = d.model_id AND s.w = isodow(d.day)"""
)


def _line(repos: DataFrame, daily: DataFrame) -> DataFrame:
    return _rounded(forecast.weekday_trend_forecast(repos, daily))


@query("j02_weekday_trend_created", MAIN.rstrip() + LINE.format(date="created_at", keep="true"))
def j02(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder, closed_at=False)
    return _line(repos, forecast.created(discussions))


@query("j03_weekday_trend_closed", MAIN.rstrip() + LINE.format(date="closed_at", keep="status = 'closed'"))
def j03(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = main(spark, folder)
    return _line(repos, forecast.closed(discussions))


@query("j07_actual_and_forecast", SPARSE.rstrip() + LINE.format(date="created_at", keep="true"))
def j07(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = events(spark, folder)
    return _line(repos, forecast.created(discussions))


# Customers as repositories with few orders each: some series are too short to fit.
SHORT = f"""WITH {SPARSE_REPOS}, discussions AS (
  SELECT o_custkey AS repo_id, o_orderdate AS created_at, o_orderpriority = '1-URGENT' AS keep FROM orders)"""


def short_series(spark: SparkSession, folder: str) -> DataFrame:
    urgent = table(spark, folder, "orders").selectExpr(
        "o_custkey AS repo_id", "o_orderdate AS created_at", "o_orderpriority = '1-URGENT' AS is_pull_request"
    )
    return forecast.daily_series(sparse_repos(spark, folder), forecast.pull_requests(urgent))


def _report_sql(least: int) -> str:
    return (
        SHORT
        + SERIES.format(date="created_at", keep="keep")
        + f" SELECT model_id, CAST(n AS INTEGER) AS points, CASE WHEN n < {least} THEN 'too short' ELSE 'ok' END AS status"
        " FROM numbered WHERE i = 1"
    )


@query("j08_fit_report_smoothing", _report_sql(3))
def j08_holt(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.fit_report(forecast.holt_fits(short_series(spark, folder)))


@query("j08_fit_report_additive", _report_sql(2))
def j08_additive(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.fit_report(forecast.additive_fits(short_series(spark, folder)))


# Input of all forecasts: the gathered series themselves.
@query("j00_daily_series", f"WITH {SPARSE_REPOS}, {EVENT_DISCUSSIONS}" + SERIES.format(date="created_at", keep="true")
       + " SELECT model_id, CAST(max(n) AS INTEGER) AS days, min(day) AS first_day, max(day) AS last_day, sum(y) AS total"
       " FROM numbered GROUP BY model_id")  # fmt: skip
def j00(spark: SparkSession, folder: str) -> DataFrame:
    repos, discussions = events(spark, folder)
    total = F.aggregate("points", F.lit(0.0), lambda s, p: s + p["value"])
    return forecast.daily_series(repos, forecast.created(discussions)).select(
        "model_id",
        F.size("points").alias("days"),
        F.element_at("points", 1)["day"].alias("first_day"),
        F.element_at("points", -1)["day"].alias("last_day"),
        total.alias("total"),
    )
