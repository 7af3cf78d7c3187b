"""Forecasts on series with a known course, and fits against brute force."""

import datetime as dt

import numpy as np
import pytest

from repopulse.functions import series as series_functions
from repopulse.functions.series import _holt_search, _slope_changes, _violation, additive_fit
from repopulse.operators import forecast

DAY0 = dt.date(2024, 1, 1)


def series(spark, **values):
    """One series per keyword: values on consecutive days, or (day, value) pairs."""
    data = []
    for name, course in values.items():
        pairs = course if course and isinstance(course[0], tuple) else list(enumerate(course))
        data.append((name, [(DAY0 + dt.timedelta(days=int(d)), float(v)) for d, v in pairs]))
    return spark.createDataFrame(data, "model_id string, points array<struct<day: date, value: double>>")


def ahead(df, name):
    rows = df.filter(f"model_id = '{name}' AND kind = 'forecast' AND step > 0").orderBy("step").collect()
    return [r.day for r in rows], np.array([r.value for r in rows])


def one_step_sse(y, alpha, beta, level, trend):
    total = 0.0
    for value in y:
        expected = level + trend
        error = value - expected
        level, trend, total = expected + alpha * error, trend + beta * error, total + error * error
    return total


def test_series_are_gathered_in_order(spark):
    repos = spark.createDataFrame([(1, "a"), (2, "b")], "id long, model_id string")
    days = [(1, 5), (1, 2), (1, 2), (1, 9), (3, 1)]
    threads = spark.createDataFrame(
        [(r, True, "closed", dt.datetime(2024, 1, d, 13), dt.datetime(2024, 2, d)) for r, d in days],
        "repo_id long, is_pull_request boolean, status string, created_at timestamp_ntz, closed_at timestamp_ntz",
    )
    for daily, month in ((forecast.created, 1), (forecast.pull_requests, 1), (forecast.closed, 2)):
        found = forecast.daily_series(repos, daily(threads)).collect()
        assert [(r.model_id, [(p.day, p.value) for p in r.points]) for r in found] == [
            ("a", [(dt.date(2024, month, 2), 2.0), (dt.date(2024, month, 5), 1.0), (dt.date(2024, month, 9), 1.0)])
        ]


def test_holt_continues_an_exact_line(spark):
    frame = series(spark, line=[1, 3, 5], short=[1, 2], longer=[10 - 0.5 * i for i in range(40)])
    found = forecast.holt_forecast(frame)
    days, values = ahead(found, "line")
    assert days == [DAY0 + dt.timedelta(days=2 + h) for h in range(1, 8)]
    assert np.allclose(values, 5 + 2 * np.arange(1, 8), atol=1e-6)
    assert np.allclose(ahead(found, "longer")[1], 10 - 0.5 * np.arange(40, 47), atol=1e-6)
    assert found.filter("model_id = 'short'").count() == 0
    actual = found.filter("model_id = 'line' AND kind = 'actual'").orderBy("day").collect()
    assert [(r.value, r.step) for r in actual] == [(1.0, None), (3.0, None), (5.0, None)]


def test_holt_labels_days_after_the_last_even_with_gaps(spark):
    days, _ = ahead(forecast.holt_forecast(series(spark, g=[(0, 1), (4, 2), (9, 2), (30, 5)])), "g")
    assert days[0] == DAY0 + dt.timedelta(days=31) and len(days) == 7


def test_holt_fixed_by_hand(spark):
    y, level, trend = [2.0, 5.0, 4.0, 8.0], 2.0, 0.0
    for value in y:
        expected = level + trend
        level, trend = expected + 0.4 * (value - expected), trend + 0.2 * (value - expected)
    _, values = ahead(forecast.holt_fixed(series(spark, y=y), 0.4, 0.2), "y")
    assert np.allclose(values, level + trend * np.arange(1, 8))


def test_holt_fit_beats_every_neighbour():
    rng = np.random.default_rng(5)
    courses = [
        np.cumsum(rng.normal(0.2, 1, 60)) + 20,
        rng.poisson(3, 200).astype(float),
        np.concatenate([np.linspace(0, 5, 30), np.linspace(5, -10, 30)]) + rng.normal(0, 0.1, 60),
        np.array([1.0, 4.0, 2.0]),
    ]
    courses.sort(key=lambda c: -len(c))
    for y, (alpha, beta, level, trend) in zip(courses, _holt_search(courses), strict=True):
        assert 0 < beta <= alpha < 1
        best = one_step_sse(y, alpha, beta, level, trend)
        for dl in (-0.05, 0, 0.05):
            for db in (-0.02, 0, 0.02):
                assert best <= one_step_sse(y, alpha, beta, level + dl, trend + db) + 1e-9
        # No grid point with freely chosen start values does better.
        for a in np.linspace(0.02, 0.98, 25):
            for share in np.linspace(0.02, 0.98, 25):
                shift = np.array([one_step_sse(y, a, a * share, l, b) for l, b in ((0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2))])
                c = shift[0]
                h11, h22 = (shift[4] - 2 * shift[1] + c) / 2, (shift[5] - 2 * shift[2] + c) / 2
                h12 = (shift[3] - shift[1] - shift[2] + c) / 2
                g = np.array([shift[1] - c - h11, shift[2] - c - h22])
                low = c - 0.25 * g @ np.linalg.solve(np.array([[h11, h12], [h12, h22]]) + 1e-12 * np.eye(2), g)
                assert best <= low * (1 + 1e-3) + 1e-6


def test_search_in_chunks_equals_search_alone():
    rng = np.random.default_rng(2)
    courses = sorted((rng.poisson(4, n).astype(float) for n in rng.integers(3, 50, 20)), key=lambda c: -len(c))
    together = _holt_search(courses)
    alone = np.vstack([_holt_search([c]) for c in courses])
    assert np.allclose(together, alone)


SEASON = np.array([3.0, 1, 0, -1, -2, 0, 2])


def weekly(n):
    day = np.arange(n)
    return 10 + 0.5 * day + SEASON[day % 7]


def test_additive_recovers_line_and_weekdays(spark):
    _, values = ahead(forecast.additive_forecast(series(spark, w=list(weekly(56)))), "w")
    assert np.allclose(values, weekly(70)[56:], atol=0.01)


def test_weekday_trend_recovers_line_and_weekdays(spark):
    repos = spark.createDataFrame([(1, "w"), (2, "short")], "id long, model_id string")
    counts = [(1, DAY0 + dt.timedelta(days=i), int(2 * v)) for i, v in enumerate(weekly(56))] + [(2, DAY0, 4)]
    daily = spark.createDataFrame(counts, "repo_id long, day date, daily_discussions long")
    found = forecast.weekday_trend_forecast(repos, daily, periods=7)
    days, values = ahead(found, "w")
    assert days == [DAY0 + dt.timedelta(days=56 + h) for h in range(7)]
    # Weekday effects that are not balanced over time leave a little slope in the line.
    assert np.allclose(values, 2 * weekly(63)[56:], atol=0.8)
    assert found.filter("kind = 'forecast' AND step = 0").count() == 56
    assert found.filter("model_id = 'short'").count() == 0


def test_additive_covers_history_and_horizon(spark):
    found = forecast.additive_forecast(series(spark, two=[1.0, 2.0], one=[1.0]))
    assert found.filter("model_id = 'one'").count() == 0
    assert found.filter("kind = 'actual'").count() == 2
    assert found.filter("kind = 'forecast' AND step = 0").count() == 2
    assert np.allclose(ahead(found, "two")[1], np.arange(3, 17), atol=0.05)


def test_additive_follows_a_change_of_trend():
    days = np.arange(120)
    y = np.where(days < 60, 5.0 + days, 65.0 - 2 * (days - 60)) + 200
    fitted = additive_fit(days, y, 14)[0]
    assert np.abs(fitted[:120] - y).max() < 12
    assert fitted[-1] < fitted[119]


def test_additive_fits_a_yearly_cycle_only_with_two_years():
    days = np.arange(1100)
    y = 50 + 10 * np.sin(2 * np.pi * days / 365.25)
    assert np.abs(additive_fit(days, y, 100)[0][1100:] - (50 + 10 * np.sin(2 * np.pi * np.arange(1100, 1200) / 365.25))).max() < 1
    half = additive_fit(days[:400], y[:400], 100)[0]
    assert np.isfinite(half).all()


@pytest.mark.parametrize("course", [[0.0] * 20, [5.0] * 20, [1.0, 0.0], [1e9, 2e9, 1e9, 5e9]])
def test_additive_survives_degenerate_series(course):
    assert np.isfinite(additive_fit(np.arange(len(course)), np.array(course), 14)[0]).all()


def test_slope_changes_reach_the_optimum_of_a_slow_descent():
    rng = np.random.default_rng(3)
    for trial in range(10):
        t = np.linspace(0, 1, 80)
        columns = [np.ones(80), t, *(np.maximum(t - c, 0) for c in np.linspace(0.05, 0.8, 12))]
        history = np.column_stack(columns)
        y = np.abs(t - 0.4) * (trial % 3) + rng.normal(0, 0.05, 80)
        hessian, moment = history.T @ history + np.diag([1e-4, 1e-4, *[0.0] * 12]), history.T @ y
        for penalty in (0.01, 0.2, 5.0):
            found = _slope_changes(hessian, moment, slice(2, 14), penalty, np.zeros(14))
            assert _violation(hessian, moment, slice(2, 14), penalty, found) < 1e-9
            # Coordinate descent with soft thresholds, from the found point and from zero, finds nothing lower.
            goal = lambda w: w @ hessian @ w / 2 - moment @ w + penalty * np.abs(w[2:]).sum()  # noqa: E731, B023
            slow = np.zeros(14)
            for _ in range(3000):
                for k in range(14):
                    rest = moment[k] - hessian[k] @ slow + hessian[k, k] * slow[k]
                    slow[k] = (np.sign(rest) * max(abs(rest) - penalty, 0) if k >= 2 else rest) / hessian[k, k]
            assert goal(found) <= goal(slow) + 1e-9


def test_every_fit_settles_whatever_the_series():
    rng = np.random.default_rng(4)
    for n in (2, 3, 5, 8, 30, 90, 400, 900):
        days = np.sort(rng.choice(3 * n, n, replace=False))
        for course in (rng.poisson(2, n) + 1.0, np.ones(n), 3.0 + days, rng.normal(0, 1e6, n), np.where(days > n, 1e6, 1.0)):
            fitted, off = additive_fit(days, np.asarray(course, float), 14)
            assert len(fitted) == n + 14 and np.isfinite(fitted).all() and off < 1e-9


def test_a_long_series_needs_one_exact_search(monkeypatch):
    rng = np.random.default_rng(5)
    days = np.arange(500)
    y = rng.poisson(3, 500) + 1.0 + np.abs(days - 250) / 20
    calls = []
    monkeypatch.setattr(series_functions, "_slope_changes", lambda *given: calls.append(given) or _slope_changes(*given))
    fitted, off = additive_fit(days, y, 14)
    assert len(calls) == 1 and off < 1e-9
    monkeypatch.setattr(series_functions, "REDUCED", 100)
    assert np.allclose(additive_fit(days, y, 14)[0], fitted, rtol=1e-9)
    assert len(calls) > 2


def test_days_that_come_twice_are_fitted_as_before():
    rng = np.random.default_rng(6)
    for n in (16, 30, 60):
        days = np.repeat(np.sort(rng.choice(2 * n, n, replace=False)), 2)
        fitted, off = additive_fit(days, np.repeat(rng.poisson(2, n) + 1.0, 2), 14)
        assert np.isfinite(fitted).all() and off < 1e-9


def test_additive_leaves_the_noise():
    rng = np.random.default_rng(9)
    days = np.sort(rng.choice(200, 120, replace=False))
    y = 20 + 0.1 * days + SEASON[days % 7] + rng.normal(0, 1, 120)
    fitted = additive_fit(days, y, 0)[0]
    assert 0.7 < np.std(y - fitted) < 1.1


def test_fit_reports_name_every_series(spark, rows):
    frame = series(spark, a=[1, 2, 3, 4], b=[1, 2], c=[1])
    assert rows(forecast.fit_report(forecast.holt_fits(frame))) == [("a", 4, "ok"), ("b", 2, "too short"), ("c", 1, "too short")]
    assert rows(forecast.fit_report(forecast.additive_fits(frame))) == [("a", 4, "ok"), ("b", 2, "ok"), ("c", 1, "too short")]


def test_a_failing_series_is_reported_and_the_others_go_on(spark, rows):
    frame = series(spark, bad=[1.0, float("nan"), 3.0, 4.0], good=[1.0, 2.0, 3.0, 4.0])
    for fits, forecasts in ((forecast.holt_fits, forecast.holt_forecast), (forecast.additive_fits, forecast.additive_forecast)):
        assert rows(forecast.fit_report(fits(frame)), "model_id", "status") == [("bad", "failed"), ("good", "ok")]
        assert {r.model_id for r in forecasts(frame).collect()} == {"good"}
