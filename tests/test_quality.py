"""Table checks and the batch validator."""

import datetime as dt

from repopulse.operators import quality

DAY = dt.datetime(2025, 1, 6)
BATCH = "model_id string, hf_discussion_num long, status string, created_at timestamp_ntz"
REPO = "id long, model_id string, likes long, downloads long"
THREAD = "repo_id long, hf_discussion_num long, status string, created_at timestamp_ntz, closed_at timestamp_ntz"


def counts(df):
    return df.collect()[0].asDict()


def test_validator_counts_each_kind_once(spark):
    frame = spark.createDataFrame(
        [
            ("ok/repo", 1, "open", DAY),
            ("ok/repo", 1, "open", DAY),
            ("ok/repo", 2, "garbage", None),
            (None, 3, "closed", DAY),
        ],
        BATCH,
    )
    assert set(counts(quality.validate_discussions(frame)).values()) == {1}


def test_validator_on_nulls_absent_columns_and_empty_frames(spark):
    twins = spark.createDataFrame([(None, 3, None, DAY), (None, 3, None, DAY), (None, None, "open", DAY)], BATCH)
    assert counts(quality.validate_discussions(twins)) == {
        "missing_model_id": 3,
        "missing_created_at": 0,
        "duplicate_discussions": 1,
        "invalid_status_values": 2,
    }
    for frame in (twins.select("created_at"), twins.select("hf_discussion_num", "created_at").limit(0), twins.limit(0)):
        assert set(counts(quality.validate_discussions(frame)).values()) == {0}
    assert counts(quality.validate_discussions(twins.select("hf_discussion_num")))["duplicate_discussions"] == 1


def tables(spark):
    repos = spark.createDataFrame([(1, "a", 0, -1), (2, None, -5, 3), (3, "c", 0, 0)], REPO)
    threads = spark.createDataFrame(
        [
            (1, 1, "open", DAY, None),
            (1, 1, "closed", DAY, DAY),
            (1, 1, None, None, DAY),
            (None, 7, "merged", DAY, DAY - dt.timedelta(seconds=1)),
            (None, 7, "open", DAY, DAY + dt.timedelta(seconds=1)),
        ],
        THREAD,
    )
    return repos, threads


def test_all_checks_in_order(spark):
    found = [(r.check_name, r.offending_rows) for r in quality.table_checks(*tables(spark)).collect()]
    assert found == [
        ("models.total_rows", 3),
        ("discussions.total_rows", 5),
        ("models.missing_model_id", 1),
        ("discussions.missing_repo_id", 2),
        ("discussions.missing_created_at", 1),
        ("discussions.duplicate_per_repo", 3),
        ("discussions.invalid_status_values", 2),
        ("discussions.closed_before_created", 1),
        ("models.negative_likes", 1),
        ("models.negative_downloads", 1),
    ]


def test_named_checks_agree_with_all(spark):
    frames = tables(spark)
    everything = {r.check_name: r.offending_rows for r in quality.table_checks(*frames).collect()}
    for names in (("discussions.missing_repo_id",), ("models.negative_likes", "discussions.duplicate_per_repo")):
        some = quality.table_checks(*frames, names).collect()
        assert [(r.check_name, r.offending_rows) for r in some] == [(n, everything[n]) for n in quality.CHECKS if n in names]


def test_summary_ignores_informational_checks(spark):
    repos, threads = tables(spark)
    assert counts(quality.summary(quality.table_checks(repos, threads))) == {"failed_checks": 8, "all_passed": False}
    empty = quality.table_checks(repos.limit(0), threads.limit(0))
    assert {r.offending_rows for r in empty.collect()} == {0}
    assert counts(quality.summary(empty)) == {"failed_checks": 0, "all_passed": True}
    clean = quality.table_checks(repos.filter("id = 3"), threads.limit(1))
    assert quality.failures(clean).count() == 0


def test_duplicates_are_counted_in_a_named_number_of_tasks(spark):
    """Adaptive execution would merge the keys, few bytes each, into tasks that hold millions of them."""
    df = spark.range(100).selectExpr("id % 50 AS repo_id", "CASE WHEN id % 10 = 0 THEN NULL ELSE id % 50 END AS hf_discussion_num")
    found = quality.duplicate_count(df, ["repo_id", "hf_discussion_num"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1
    assert found.first().duplicate_rows == 50
