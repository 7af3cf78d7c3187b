"""Cleaning rules on small frames."""

import datetime as dt

import pytest

from repopulse.operators.cleaning import add_weekday, clean_discussions, clean_models
from repopulse.schemas import DISCUSSIONS, MODEL_REPOS, enforce

MODELS = "model_id string, tag string, author string, likes long, downloads long, pipeline_tag string"
THREADS = (
    "model_id string, hf_discussion_num long, title string, author string, is_pull_request boolean, status string,"
    " created_at timestamp_ntz, closed_at timestamp_ntz"
)
MONDAY = dt.datetime(2025, 1, 6)


def test_models_need_key_and_tag(spark, rows):
    raw = spark.createDataFrame(
        [
            ("ok/repo", "text-generation", None, 5, 10, None),
            (None, "text-generation", None, None, None, None),
            ("", "text-generation", None, 1, 1, None),
            ("missing/tag", None, None, 1, 1, None),
            ("empty/tag", "", None, 1, 1, None),
            ("weird/repo", "text-generation", " \t", -3, -10, " asr\n"),
            ("  ", " t ", " me ", None, None, ""),
        ],
        MODELS,
    )
    assert rows(clean_models(raw)) == [
        ("", "t", "me", 0, 0, None),
        ("ok/repo", "text-generation", None, 5, 10, None),
        ("weird/repo", "text-generation", None, 0, 0, "asr"),
    ]


def test_discussions_are_normalised(spark, rows):
    raw = spark.createDataFrame(
        [
            ("ok/repo", 1, " Q ", "  ", None, " CLOSED", MONDAY, MONDAY),
            (" ok/repo", 0, None, "me", True, "merged", None, None),
            ("ok/repo", 2, "Q2", None, False, None, MONDAY + dt.timedelta(days=6, hours=23), None),
            (None, 1, "x", None, None, "open", MONDAY, None),
            ("", 1, "x", None, None, "open", MONDAY, None),
            ("ok/repo", None, "x", None, None, "open", MONDAY, None),
        ],
        THREADS,
    )
    columns = ("model_id", "hf_discussion_num", "title", "author", "is_pull_request", "status", "weekday")
    assert rows(clean_discussions(raw), *columns) == [
        ("ok/repo", 0, "", "me", True, "open", None),
        ("ok/repo", 1, "Q", None, False, "closed", "Monday"),
        ("ok/repo", 2, "Q2", None, False, "open", "Sunday"),
    ]


def test_add_weekday_keeps_other_columns(spark, rows):
    frame = spark.createDataFrame([(1, dt.datetime(2025, 1, 8, 12)), (2, None)], "n int, created_at timestamp_ntz")
    assert rows(add_weekday(frame), "n", "weekday") == [(1, "Wednesday"), (2, None)]


def test_enforce_fills_defaults_and_fails_on_null_keys(spark, rows):
    frame = spark.createDataFrame([(1, "a", "t", "dropped")], "id int, model_id string, tag string, extra string")
    table = enforce(frame, MODEL_REPOS)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in MODEL_REPOS]
    assert rows(table) == [(1, "a", "t", None, 0, 0, None, None, None)]
    bad = spark.createDataFrame([(1, None, 3, "t")], "id long, repo_id long, hf_discussion_num long, title string")
    with pytest.raises(Exception, match="null in required column repo_id"):
        enforce(bad, DISCUSSIONS).collect()
