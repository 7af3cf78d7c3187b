"""The fixed questions as ordered reports: ``REPORTS[name](repos, discussions)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.operators import activity, forecast, metrics, windows


def most_discussed(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.discussions_per_repo(repos, discussions).orderBy(F.desc("discussion_count"), "model_id")


def repo_weekday_table(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    counts = activity.by_repo_and_weekday(repos, discussions)
    return counts.orderBy("model_id", "weekday_order").drop("weekday_order")


def repo_weekday_grid(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.weekday_grid(repos, discussions).orderBy("model_id")


def created_weekdays(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    counts = activity.created_by_weekday(discussions)
    return counts.orderBy(F.desc("total_discussions"), "weekday_order").drop("weekday_order")


def closed_weekdays(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    counts = activity.closed_by_weekday(discussions)
    return counts.orderBy(F.desc("closed_discussions"), "weekday_order").drop("weekday_order")


def closure_rates(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.closure_rates(repos, discussions).orderBy(F.desc_nulls_last("closure_rate"), "model_id")


def total_over_time(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.daily_totals(discussions).orderBy("day")


def daily_per_repo(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.daily_per_repo(repos, discussions).orderBy("model_id", "day")


def rolling_average(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return windows.rolling_average(repos, discussions).orderBy("model_id", "day")


def spikes(
    repos: DataFrame, discussions: DataFrame, window: int = 7, multiplier: float = 2.0, min_daily: int = 3
) -> DataFrame:
    found = windows.spikes(repos, discussions, window, multiplier, min_daily)
    return found.orderBy(F.desc("spike_ratio"), "model_id", "day")


def share_per_repo(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.share_of_total(repos, discussions).orderBy(F.desc("discussion_count"), "model_id")


def likes_per_repo(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return repos.select("model_id", "likes").orderBy(F.desc("likes"), "model_id")


def downloads_per_repo(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return repos.select("model_id", "downloads").orderBy(F.desc("downloads"), "model_id")


def closed_per_week(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.closed_per_week(discussions).orderBy("week")


def open_versus_closed(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return activity.open_and_closed(repos, discussions).orderBy("model_id", F.desc("status"))


def engagement(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return metrics.engagement(repos, discussions).orderBy(F.desc("engagement_score"), "model_id")


def created_forecast(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return forecast.additive_forecast(forecast.daily_series(repos, forecast.created(discussions)))


def closed_forecast(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return forecast.additive_forecast(forecast.daily_series(repos, forecast.closed(discussions)))


def pull_request_forecast(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    return forecast.holt_forecast(forecast.daily_series(repos, forecast.pull_requests(discussions)))


def commit_forecast(repos: DataFrame, discussions: DataFrame) -> DataFrame:
    """All discussion activity stands in for commits."""
    return forecast.holt_forecast(forecast.daily_series(repos, forecast.created(discussions)))


def _first(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda repos, discussions: report(repos, discussions).limit(1)


REPORTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "most_discussed_repo": _first(most_discussed),
    "repo_weekday_table": repo_weekday_table,
    "busiest_created_weekday": _first(created_weekdays),
    "busiest_closed_weekday": _first(closed_weekdays),
    "total_over_time": total_over_time,
    "share_per_repo": share_per_repo,
    "likes_per_repo": likes_per_repo,
    "downloads_per_repo": downloads_per_repo,
    "closed_per_week": closed_per_week,
    "open_versus_closed": open_versus_closed,
    "created_forecast": created_forecast,
    "closed_forecast": closed_forecast,
    "pull_request_forecast": pull_request_forecast,
    "commit_forecast": commit_forecast,
}
