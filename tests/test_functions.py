"""Column functions against Python's own rules."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.functions import numbers, text, time

BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace()]


def values(spark, column, data, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r.out for r in frame.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_removes_what_python_removes(spark):
    rng = random.Random(7)
    alphabet = [*BLANKS, "a", "é", "​", "\x00", "-"]
    data = ["".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(2000)] + [f"{b}x {b}" for b in BLANKS]
    assert values(spark, text.strip, data) == [d.strip() for d in data]


def test_optional_and_required_strings(spark):
    data = [None, "", "  ", " a b "]
    assert values(spark, text.optional_string, data) == [None, None, None, "a b"]
    assert values(spark, text.required_string, data) == ["", "", "", "a b"]


@pytest.mark.parametrize(
    ("given", "cleaned", "listed"),
    [
        ("closed", "closed", "closed"),
        ("CLOSED", "closed", "closed"),
        (" Closed\n", "closed", "open"),
        ("merged", "open", "open"),
        ("", "open", "open"),
        (None, "open", "open"),
    ],
)
def test_status(spark, given, cleaned, listed):
    assert values(spark, text.canonical_status, [given]) == [cleaned]
    assert values(spark, text.listed_status, [given]) == [listed]


def test_fence_is_only_removed_around_the_whole_text(spark):
    data = [
        "```python\nprint(1)\n```",
        "  ```\n a\n\nb \n```  ",
        "```sql\nselect 1\n```",
        "see\n```python\nx\n```",
        "```python\nx\n```\ny\n```",
        "plain ",
    ]
    want = ["print(1)", "a\n\nb", "```sql\nselect 1\n```", "see\n```python\nx\n```", "x\n```\ny", "plain"]
    assert values(spark, text.without_fence, data) == want


def test_question_kind_matches_inside_words(spark):
    data = ["Who is online?", "PIE please", "the most discussed repo", "Histograms", "", "barely"]
    assert values(spark, text.question_kind, data) == ["chart", "chart", "text", "chart", "text", "chart"]


def test_non_negative(spark):
    assert values(spark, numbers.non_negative, [None, -3.0, 1.9, 0.0, 7.0], "double") == [0, 0, 1, 0, 7]
    assert values(spark, numbers.non_negative, [" 12 ", None]) == [12, 0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, numbers.non_negative, ["many"])


def test_rounding_rules_differ_on_ties(spark):
    pairs = [(1, 8), (1, 16), (23, 40), (3, 8), (2, 3), (5, 0), (0, 5)]
    frame = spark.createDataFrame(pairs, "p long, q long")
    got = frame.select(
        numbers.ratio_half_up(F.col("p"), F.col("q"), 2).alias("up"),
        numbers.ratio_half_even(F.col("p"), F.col("q"), 3).alias("even"),
    ).collect()
    assert [r.up for r in got] == [Decimal(s) for s in ("0.13", "0.06", "0.58", "0.38", "0.67")] + [None, Decimal("0.00")]
    assert [r.even for r in got] == [0.125, 0.062, 0.575, 0.375, 0.667, None, 0.0]


def test_half_even_equals_numpy(spark):
    data = [float(x) for x in np.random.default_rng(3).integers(0, 20000, 3000) / 800]
    got = values(spark, lambda c: numbers.round_half_even(c, 2), data, "double")
    assert got == [float(np.round(x, 2)) for x in data]


def test_min_max_of_constant_column_is_zero(spark):
    frame = spark.createDataFrame([(5,), (5,)], "v long")
    got = frame.select(numbers.min_max(F.col("v"), F.lit(5), F.lit(5)).alias("out")).collect()
    assert [r.out for r in got] == [0.0, 0.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_weekdays_and_weeks_do_not_depend_on_the_zone(spark, zone):
    days = [dt.datetime(2025, 1, 6) + dt.timedelta(hours=7 * i) for i in range(400)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text_days = [d.isoformat() for d in days]
        names = values(spark, lambda c: time.weekday_name(c.cast("timestamp_ntz")), [*text_days, None])
        starts = values(spark, lambda c: time.week_start(c.cast("timestamp_ntz")), text_days)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert names == [d.strftime("%A") for d in days] + [None]
    assert starts == [d.date() - dt.timedelta(days=d.weekday()) for d in days]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_iso_times_become_utc(spark, zone):
    data = [
        "2025-01-06",
        "2025-01-06T10",
        "2025-01-06 10:11",
        "2025-03-30T02:30:00",  # skipped hour in Berlin
        "2025-01-06T10:11:12.123Z",
        "2025-01-06T10:11:12,5",
        "2025-01-06T10:11:12.123456+05:30",
        "2025-01-06T23:11:12-0200",
        "2025-01-06T10:11:12+02",
        "2025-01-06T10:11:12." + "1" * 60 + "+02:00",
        "2025-01-06T10:11:12+23:59:59",
        "2025-01-06T10:11:12-20:30",
        "2025-01-06T10:11:12+24:00",
        "20250106",
        "20250106T050607Z",
        "2025-01-06T120000",
        "20250106 0506",
        "2025-W02-1",
        "2025-W02",
        "2025W027T10",
        "2020-W53-7",
        "2021-W53-1",
        "2025-W00-1",
        "2025-W02-8",
        "0000-01-01",
        "0000-W02-1",
        "0001-01-01",
        "9999-12-31T23:59:59",
        "2025-0106",
        "2025-01-06T10:1112",
        "2025",
        "2025-01",
        "2025-1-6",
        "10:11:12",
        "T10:11",
        "2025-02-30",
        "2025-01-06T25:00:00",
        "soon",
        "",
        None,
    ]

    def expected(value):
        try:
            moment = dt.datetime.fromisoformat(value)
        except (ValueError, TypeError):
            return None
        return moment.astimezone(dt.UTC).replace(tzinfo=None) if moment.tzinfo else moment

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, time.parse_iso, data)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [expected(v) for v in data]


def test_iso_forms_of_both_tiers_equal_the_parser_of_python(spark):
    """Some hundred forms: every date by every clock by every zone, and years at the ends of the range."""
    dates = ["2024-02-29", "2023-02-29", "0001-01-01", "9999-12-31", "20240131", "2024-W09-4", "2024W094", "2023-W53-1", "2024-1-01", "0000-05-05"]
    clocks = ["", "T00:00:00", "T23:59:59.999999", " 12:34:56.7", "T24:00:00", "T12:60:00", "T0102", "T01", "t05:06:07", "T05:06:07,25", "T05:06:07.1234567"]
    zones = ["", "Z", "+00:00", "+02:00", "-23:59", "-0130", "+14:59", "+15:00", "+05", "+01:02:03", "z", "+1:00"]
    data = [d + c + z for d in dates for c in clocks for z in zones if c or not z]

    def plain(text):
        try:
            moment = dt.datetime.fromisoformat(text)
            return moment if moment.tzinfo is None else moment.astimezone(dt.UTC).replace(tzinfo=None)
        except (ValueError, OverflowError):
            return None

    got = values(spark, time.parse_iso, data)
    assert len(data) > 1000 and [(t, g) for t, g in zip(data, got, strict=True) if g != plain(t)] == []
