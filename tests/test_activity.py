"""Counts, joins, windows and scores on small frames, against plain Python."""

import collections
import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.operators import activity, joins, metrics, ranking, views, windows
from repopulse.plans import reports

REPO = "id long, model_id string, tag string, likes long, downloads long"
THREAD = "repo_id long, hf_discussion_num long, is_pull_request boolean, status string, created_at timestamp_ntz, closed_at timestamp_ntz"
DAY0 = dt.datetime(2024, 2, 26)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    repos = [(i, f"m{i}", f"t{i % 2}", rng.randint(0, 9), rng.randint(0, 99)) for i in range(6)]
    threads = []
    for n in range(900):
        repo = rng.choice([0, 0, 0, 0, 1, 2, 3, 9, None])  # 0 is hot, 4 and 5 are quiet, 9 is unknown
        created = None if rng.random() < 0.05 else DAY0 + dt.timedelta(hours=rng.randint(0, 24 * 40))
        status = rng.choice(["open", "closed", "closed", "merged", None])
        closed = DAY0 + dt.timedelta(days=rng.randint(0, 60)) if status == "closed" and rng.random() < 0.9 else None
        threads.append((repo, n, rng.random() < 0.3, status, created, closed))
    return repos, threads


@pytest.fixture(scope="module")
def frames(spark, data):
    return spark.createDataFrame(data[0], REPO), spark.createDataFrame(data[1], THREAD)


def test_counts_per_repo_skip_unknown_and_quiet_repos(frames, data, rows):
    want = collections.Counter(f"m{t[0]}" for t in data[1] if t[0] is not None and t[0] < 6)
    assert rows(activity.discussions_per_repo(*frames)) == sorted(want.items(), key=repr)


def test_closure_rates_keep_quiet_repos(frames, data, rows):
    def line(repo):
        mine = [t for t in data[1] if t[0] == repo[0]]
        closed = sum(t[3] == "closed" for t in mine)
        opened = sum(t[3] == "open" for t in mine)
        rate = Decimal((200 * closed + len(mine)) // (2 * len(mine))) / 100 if mine else None
        return (repo[1], len(mine), closed, opened, rate)

    assert rows(activity.closure_rates(*frames)) == sorted(map(line, data[0]), key=repr)


def test_weekday_reports_are_in_calendar_order(frames, data):
    report = [tuple(r) for r in reports.repo_weekday_table(*frames).collect()]
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert report == sorted(report, key=lambda r: (r[0], names.index(r[1])))
    want = collections.Counter(
        (f"m{t[0]}", t[4].strftime("%A")) for t in data[1] if t[0] is not None and t[0] < 6 and t[4] is not None
    )
    assert {(m, d): n for m, d, n in report} == want


def test_weekday_totals_count_unknown_repos_too(frames, data):
    created = reports.created_weekdays(*frames).collect()
    assert {r.weekday: r.total_discussions for r in created} == collections.Counter(
        t[4].strftime("%A") for t in data[1] if t[4] is not None
    )
    closed = reports.closed_weekdays(*frames).collect()
    assert {r.weekday: r.closed_discussions for r in closed} == collections.Counter(
        t[5].strftime("%A") for t in data[1] if t[3] == "closed" and t[5] is not None
    )
    assert [r.closed_discussions for r in closed] == sorted((r.closed_discussions for r in closed), reverse=True)


def test_headline_agrees_with_the_single_reports(frames):
    row = metrics.headline(*frames).collect()[0]
    top = reports.most_discussed(*frames).first()
    created = reports.created_weekdays(*frames).first()
    closed = reports.closed_weekdays(*frames).first()
    best = reports.closure_rates(*frames).first()
    assert (row.busiest_repo, row.busiest_repo_discussions) == (top.model_id, top.discussion_count)
    assert (row.busiest_created_weekday, row.busiest_created_count) == (created.weekday, created.total_discussions)
    assert (row.busiest_closed_weekday, row.busiest_closed_count) == (closed.weekday, closed.closed_discussions)
    assert (row.best_closure_repo, row.best_closure_rate) == (best.model_id, best.closure_rate)


def test_headline_of_empty_tables_is_empty(spark, frames):
    row = metrics.headline(frames[0].limit(0), frames[1].limit(0)).collect()[0]
    assert row.busiest_repo is None and row.busiest_created_weekday is None and row.best_closure_rate is None


def test_shares_sum_to_100(frames):
    shares = [r.percent for r in activity.share_of_total(*frames).collect()]
    assert sum(shares) == pytest.approx(100)


def test_concentration_is_cumulative(frames):
    top = activity.concentration(*frames, top=3).orderBy("rank").collect()
    assert [r.cumulative_count for r in top] == list(np.cumsum([r.discussion_count for r in top]))
    assert top[0].model_id == "m0"


def test_views(spark, frames, rows):
    repos, discussions = frames
    odd = discussions.withColumn("status", F.concat(F.lit("  "), F.upper("status"), F.lit(" ")))
    full = odd.withColumns({"id": F.col("hf_discussion_num"), "title": F.lit("t"), "author": F.lit(None).cast("string")})
    views.create_views(spark, repos, full)
    clean = spark.table("v_discussions_clean")
    assert {r.status for r in clean.select("status").distinct().collect()} == {"open", "closed", "merged", None}
    assert clean.filter("is_closed <> (status = 'closed')").count() == 0
    assert clean.filter("weekday_closed IS NULL").count() == clean.filter("closed_at IS NULL").count()
    assert rows(spark.table("v_discussions_by_weekday")) == rows(
        clean.filter("created_at IS NOT NULL").groupBy("model_id", "weekday_created").count()
    )
    # The summary view compares the stored status, as the closure report does.
    assert spark.table("v_model_discussion_summary").filter("closed_discussions > 0").count() == 0


def test_joined_activity_coerces_text_times(spark, frames):
    repos, discussions = frames
    text = discussions.withColumn("created_at", F.when(F.col("is_pull_request"), "never").otherwise(F.col("created_at").cast("string")))
    joined = joins.joined_activity(text, repos)
    assert joined.filter("is_pull_request AND created_at IS NOT NULL").count() == 0
    assert joined.filter("NOT is_pull_request AND created_at IS NOT NULL").count() > 0


def test_denormalised_suffixes_shared_names(spark, rows):
    discussions = spark.createDataFrame([(7, 1, "x")], "id long, repo_id long, author string")
    repos = spark.createDataFrame([(1, "y", "m")], "id long, author string, model_id string")
    joined = joins.denormalised(discussions, repos)
    assert joined.columns == ["id_disc", "repo_id", "author_disc", "id_model", "author_model", "model_id"]
    assert rows(joined) == [(7, 1, "x", 1, "y", "m")]


def daily_frames(spark, counts, gap=1):
    threads = [
        (1, i * 100 + k, False, "open", DAY0 + dt.timedelta(days=i * gap, hours=k % 24), None)
        for i, n in enumerate(counts)
        for k in range(n)
    ]
    repos = spark.createDataFrame([(1, "m", "t", 0, 0)], REPO)
    return repos, spark.createDataFrame(threads, THREAD)


def test_spike_of_a_quiet_week(spark):
    found = windows.spikes(*daily_frames(spark, [1, 1, 1, 1, 1, 1, 9])).collect()
    assert [(r.daily_discussions, r.rolling_avg, r.spike_ratio) for r in found] == [(9, 2.14, 4.2)]


def test_spike_at_exactly_the_threshold_counts(spark):
    # mean of 1, 1, 4 is 2, and 4 is exactly twice that
    assert windows.spikes(*daily_frames(spark, [1, 1, 4]), window=3).count() == 1
    assert windows.spikes(*daily_frames(spark, [1, 1, 4]), window=3, multiplier=2.01).count() == 0
    assert windows.spikes(*daily_frames(spark, [1, 1, 4]), window=3, min_daily=5).count() == 0


def test_the_ratio_never_reaches_the_window(spark):
    assert windows.spikes(*daily_frames(spark, [1, 1, 500]), window=3, multiplier=3.0).count() == 0


def test_frame_counts_rows_unless_calendar(spark):
    frames = daily_frames(spark, [1, 1, 4], gap=10)
    by_rows = windows.rolling_average(*frames).orderBy("day").collect()
    by_days = windows.rolling_average(*frames, calendar=True).orderBy("day").collect()
    assert [r.rolling_7d_avg for r in by_rows] == [1.0, 1.0, 2.0]
    assert [r.rolling_7d_avg for r in by_days] == [1.0, 1.0, 4.0]


def test_engagement(frames, data):
    table = {r.model_id: r for r in metrics.engagement(*frames).collect()}
    assert set(table) == {r[1] for r in data[0]}
    for column, norm in metrics.SCORED.items():
        raw = np.array([table[m][column] for m in table], float)
        want = (raw - raw.min()) / (raw.max() - raw.min())
        assert np.allclose([table[m][norm] for m in table], want)
    assert all(0 <= r.engagement_score <= 1 for r in table.values())
    assert table["m5"].closure_rate is None and table["m5"].total_discussions == 0
    top = metrics.top_by_engagement(*frames, n=3).collect()
    assert [r.engagement_score for r in top] == sorted((r.engagement_score for r in table.values()), reverse=True)[:3]


def test_engagement_with_a_constant_column(frames):
    repos, discussions = frames
    flat = metrics.engagement(repos.withColumn("likes", F.lit(4)), discussions).collect()
    assert {r.norm_likes for r in flat} == {0.0}


def test_top_listings_and_latest_per_key(spark, rows):
    listed = spark.createDataFrame(
        [("a", "t", 5), ("b", "t", 9), ("c", "t", 5), ("d", "u", None), ("e", "u", 0), ("f", "v", 1)],
        "model_id string, tag string, downloads long",
    )
    assert rows(ranking.top_listings(listed, ["t", "u"], 2), "model_id") == [("a",), ("b",), ("d",), ("e",)]
    assert rows(ranking.top_listings(listed, n=1), "model_id") == [("b",), ("e",), ("f",)]
    batch = spark.createDataFrame([(k, s, f"{k}{s}") for k in range(3) for s in range(50)], "k int, seq int, v string")
    assert rows(ranking.latest_per_key(batch, ["k"], ["seq"]), "v") == [("049",), ("149",), ("249",)]
