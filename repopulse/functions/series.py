"""Model fitting on one series per row. The series is an array column, bounded by the number of
days it covers; whole columns of series arrive as Arrow batches."""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Ship the functions below to executors with the query, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- Holt's linear trend -----------------------------------------------------------------------


def holt_fold(values: Column, alpha: Column, beta: Column, level: Column, trend: Column) -> Column:
    """Final ``level``, ``trend`` and the sum of squared one-step errors, in error-correction form."""
    start = F.struct(level.alias("level"), trend.alias("trend"), F.lit(0.0).alias("sse"))

    def step(state: Column, value: Column) -> Column:
        expected = state["level"] + state["trend"]
        error = value - expected
        return F.struct(
            (expected + alpha * error).alias("level"),
            (state["trend"] + beta * error).alias("trend"),
            (state["sse"] + error * error).alias("sse"),
        )

    return F.aggregate(values, start, step)


HOLT_FIT = T.StructType([T.StructField(name, T.DoubleType()) for name in ("alpha", "beta", "level", "trend")])
#: The grids, in thousandths: both parameters from 50 to 950 by 100, then around the best cell by 10, then by 1.
#: The second parameter is the share of ``alpha`` that ``beta`` is, which keeps it at or below ``alpha``.
HOLT_FIRST = tuple(range(50, 1000, 100))
HOLT_FINER = (10, 1)
HOLT_STEPS = (-4, -3, -2, -1, 0, 1, 2, 3, 4)
_CELLS = 200_000  # series x grid points held at once per task


def _holt_sse(values: np.ndarray, lengths: np.ndarray, alpha: np.ndarray, beta: np.ndarray):
    """Least squared error over the start values, per series and grid point.

    For fixed smoothing parameters the one-step errors are linear in the start level and trend, so
    the recursion carries the constant and the two coefficients, and the start values solve a two by
    two system. Series are ordered by falling length; ``alpha``/``beta`` have one row per series.
    """
    count, grid = alpha.shape
    zeros = lambda: np.zeros((count, grid))
    level, level_l, level_b = zeros(), np.ones((count, grid)), zeros()
    trend, trend_l, trend_b = zeros(), zeros(), np.ones((count, grid))
    rr, rp, rq, pp, pq, qq = (zeros() for _ in range(6))
    active = np.searchsorted(-lengths, -np.arange(values.shape[1]), side="left")
    for t in range(values.shape[1]):
        n = active[t]  # the first n series are longer than t
        a, b = alpha[:n], beta[:n]
        p = level_l[:n] + trend_l[:n]
        q = level_b[:n] + trend_b[:n]
        expected = level[:n] + trend[:n]
        r = values[:n, t, None] - expected
        rr[:n] += r * r
        rp[:n] += r * p
        rq[:n] += r * q
        pp[:n] += p * p
        pq[:n] += p * q
        qq[:n] += q * q
        level[:n] = expected + a * r
        level_l[:n] = p - a * p
        level_b[:n] = q - a * q
        trend[:n] += b * r
        trend_l[:n] -= b * p
        trend_b[:n] -= b * q
    det = pp * qq - pq * pq
    # Where the system is singular the series starts on the line through its first two points.
    flat = det <= 1e-12 * pp * qq
    safe = np.where(flat, 1.0, det)
    first_trend = (values[:, 1] - values[:, 0])[:, None]
    first_level = values[:, 0][:, None] - first_trend
    level0 = np.where(flat, first_level, (rp * qq - rq * pq) / safe)
    trend0 = np.where(flat, first_trend, (rq * pp - rp * pq) / safe)
    sse = rr - 2 * (level0 * rp + trend0 * rq) + level0**2 * pp + 2 * level0 * trend0 * pq + trend0**2 * qq
    return np.maximum(sse, 0.0), level0, trend0


def _holt_search(series: list[np.ndarray]) -> np.ndarray:
    """Rows of alpha, beta, level, trend of the cell of least squared error on each grid in turn.

    Errors are compared to six digits behind the point; ties go to the smaller alpha, then to the
    smaller share.
    """
    lengths = np.array([len(s) for s in series])
    values = np.zeros((len(series), lengths.max()))
    for row, s in zip(values, series, strict=True):
        row[: len(s)] = s
    rows = np.arange(len(series))
    alpha, share = (np.broadcast_to(g.ravel(), (len(series), g.size)) for g in np.meshgrid(HOLT_FIRST, HOLT_FIRST, indexing="ij"))
    for step in (*HOLT_FINER, None):
        sse, level, trend = _holt_sse(values, lengths, alpha / 1000, alpha / 1000 * (share / 1000))
        best = np.round(sse, 6).argmin(axis=1)
        chosen = [m[rows, best] for m in (alpha, share, level, trend)]
        if step:
            near = np.array(HOLT_STEPS) * step
            da, ds = (g.ravel()[None, :] for g in np.meshgrid(near, near, indexing="ij"))
            alpha, share = chosen[0][:, None] + da, chosen[1][:, None] + ds
    alpha, share, level, trend = chosen
    return np.column_stack([alpha / 1000, alpha / 1000 * (share / 1000), level, trend])


@pandas_udf(HOLT_FIT)
def holt_fit(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Smoothing parameters and start values of least squared one-step error, per series."""
    for batch in batches:
        values = [np.asarray(v, dtype=float) for v in batch]
        fitted = np.full((len(values), 4), np.nan)
        order = sorted((i for i, v in enumerate(values) if len(v) >= 3), key=lambda i: -len(values[i]))
        chunk = _CELLS // len(HOLT_FIRST) ** 2
        for start in range(0, len(order), chunk):
            part = order[start : start + chunk]
            fitted[part] = _holt_search([values[i] for i in part])
        yield pd.DataFrame(fitted, columns=["alpha", "beta", "level", "trend"])


# --- additive trend and seasonality ------------------------------------------------------------

# Fixed values of the published additive model (Taylor and Letham, "Forecasting at scale", 2018)
# in its default setting: prior scales, trend change points and Fourier orders.
SLOPE_SCALE = 5.0
OFFSET_SCALE = 5.0
CHANGE_SCALE = 0.05
SEASON_SCALE = 10.0
NOISE_SCALE = 0.5
LEAST_NOISE = 1e-10  # variance, in units of the largest value squared
SETTLED = 1e-6  # relative violation of the optimality conditions beyond which a fit is not used
CHANGE_POINTS = 25
CHANGE_RANGE = 0.8
REDUCED = 12  # slope changes from which a system of them alone is solved first
DAILY_ORDER = 4
WEEKLY = (7.0, 3, 14)  # period in days, Fourier order, least span in days
YEARLY = (365.25, 10, 730)


def _seasons(days: np.ndarray) -> list[tuple[float, int]]:
    """Cycles the history is long enough for."""
    span = days[-1] - days[0]
    cycles = []
    if span >= YEARLY[2]:
        cycles.append(YEARLY[:2])
    if span >= WEEKLY[2] and np.diff(days).min() < WEEKLY[0]:
        cycles.append(WEEKLY[:2])
    return cycles


def _slope_changes(hessian: np.ndarray, moment: np.ndarray, changes: slice, penalty: float, start: np.ndarray) -> np.ndarray:
    """Minimum of w'Hw/2 - m'w + penalty * |w[changes]|_1, by an active set of slope changes and their signs.

    One change of slope that violates its condition most enters at a time; the free weights then move
    towards the minimum under the present signs, as far as the objective falls and no sign turns, and
    changes that reach zero leave. Every step lowers the objective, so no set of signs comes twice and the
    search ends, with all conditions met.
    """
    weights = start.copy()
    penalised = np.zeros(len(weights), bool)
    penalised[changes] = True
    signs = np.where(penalised, np.sign(weights), 0.0)
    free = ~penalised | (signs != 0)

    def objective(w: np.ndarray) -> float:
        return w @ (hessian @ w) / 2 - moment @ w + penalty * np.abs(w[changes]).sum()

    lowest = np.inf
    while True:
        while True:
            goal = np.zeros_like(weights)
            goal[free] = np.linalg.solve(hessian[np.ix_(free, free)], moment[free] - penalty * signs[free])
            turned = np.flatnonzero(free & penalised & (np.sign(goal) != signs))
            if not len(turned):
                weights = goal
                break
            # Where a sign would turn: the lowest point among the goal and all crossings of zero on the way.
            with np.errstate(divide="ignore", invalid="ignore"):
                crossings = weights[turned] / (weights[turned] - goal[turned])
            points = [(goal, -1)]
            for place, share in zip(turned, crossings, strict=True):
                if 0 <= share < 1:
                    point = weights + share * (goal - weights)
                    point[place] = 0.0
                    points.append((point, place))
            best, place = min(points, key=lambda p: objective(p[0]))
            if place < 0 and objective(best) >= objective(weights):
                break
            weights = best
            signs = np.where(penalised, np.sign(weights), 0.0)
            free = ~penalised | (signs != 0)
        slack = np.where(penalised & ~free, np.abs(moment - hessian @ weights) - penalty, 0.0)
        worst, before = int(slack.argmax()), lowest
        lowest = objective(weights)
        # Where the objective no longer falls in double precision, the rest of the slack is rounding.
        if slack[worst] <= 1e-9 * penalty or lowest >= before:
            return weights
        free[worst] = True
        signs[worst] = np.sign(moment[worst] - hessian[worst] @ weights)


def _first_changes(
    hessian: np.ndarray, moment: np.ndarray, changes: slice, penalty: float, start: np.ndarray
) -> tuple[np.ndarray, bool]:
    """The minimum that :func:`_slope_changes` finds, but for rounding, and whether it was reached in a bounded number of steps.

    The weights without a penalty have a closed form for any slope changes, which leaves a system as wide as there are
    changes. Every step solves for those that are not zero and goes towards the minimum under the present signs until
    one turns; that change leaves. A small penalty without a start begins from the minimum without penalty.
    """
    others = np.r_[: changes.start, changes.stop : len(moment)]
    cross, free = hessian[others, changes], hessian[others[:, None], others]
    if not start[changes].any():
        whole = np.zeros(len(moment))
        whole[others] = base = np.linalg.solve(free, moment[others])
        if np.abs(moment[changes] - base @ cross).max() <= penalty * (1 + 1e-9):
            return whole, True
    solved = np.linalg.solve(free, np.column_stack([moment[others], cross]))
    base, pull = solved[:, 0], solved[:, 1:]
    left, rest = hessian[changes, changes] - cross.T @ pull, moment[changes] - cross.T @ base
    weights = start[changes].copy()
    if not weights.any() and np.abs(rest).max() > 100 * penalty:
        weights = np.linalg.solve(left, rest)
    signs = np.sign(weights)
    reached = False
    for _ in range(8 * len(weights)):
        on = np.flatnonzero(signs)
        goal = np.linalg.solve(left[on[:, None], on], rest[on] - penalty * signs[on])
        turned = np.flatnonzero(goal * signs[on] <= 0)
        if len(turned):
            now = weights[on]
            with np.errstate(divide="ignore", invalid="ignore"):
                shares = now[turned] / (now[turned] - goal[turned])
            nearest = shares.argmin()
            weights[on] = now + shares[nearest] * (goal - now)
            weights[on[turned[nearest]]] = signs[on[turned[nearest]]] = 0.0
            continue
        weights[on] = goal
        slope = rest - left @ weights
        slack = np.abs(slope)
        slack[on] = 0.0
        worst = slack.argmax()
        if reached := slack[worst] <= penalty * (1 + 1e-9):
            break
        signs[worst] = 1.0 if slope[worst] > 0 else -1.0
    whole = np.empty(len(moment))
    whole[changes], whole[others] = weights, base - pull @ weights
    return whole, bool(reached)


def _violation(hessian: np.ndarray, moment: np.ndarray, changes: slice, penalty: float, weights: np.ndarray) -> float:
    """The largest violation of a weight's condition, relative to the sizes of the terms in it."""
    gradient = hessian @ weights - moment
    size = np.abs(hessian) @ np.abs(weights) + np.abs(moment)
    size[changes] += penalty
    off = np.abs(gradient)
    moved = weights[changes] != 0
    off[changes] = np.where(moved, np.abs(gradient[changes] + penalty * np.sign(weights[changes])), np.maximum(off[changes] - penalty, 0.0))
    return float((off / np.where(size > 0, size, 1.0)).max())


def additive_fit(days: np.ndarray, values: np.ndarray, periods: int) -> tuple[np.ndarray, float]:
    """Fitted value on every day of the history and on the ``periods`` days after it, and the largest
    relative violation of the optimality conditions.

    Piecewise linear trend with Laplace-distributed slope changes plus Fourier seasons, at a posterior
    mode. For a given noise variance the weights have one optimum, found by an active set
    (:func:`_slope_changes`). The variance that is best for a sum of squares has a closed form, and
    both grow together, so their common point lies between known bounds and is found by bisection with
    secant steps. Days carry no clock time, so every cosine of the daily cycle is constant: it only
    widens the prior of the offset.
    """
    if not np.isfinite(values).all():
        raise np.linalg.LinAlgError("a value is no number")
    scale = np.abs(values).max() or 1.0
    y = values / scale
    every = np.concatenate([days, days[-1] + 1 + np.arange(periods)]).astype(float)
    t = (every - days[0]) / (days[-1] - days[0])
    n = len(days)

    head = int(np.floor(n * CHANGE_RANGE))
    changes = min(CHANGE_POINTS, head - 1)
    places = np.linspace(0, head - 1, changes + 1).round().astype(int)[1:] if changes > 0 else []
    columns = [np.ones_like(t), t, *(np.maximum(t - c, 0.0) for c in t[places])]
    variance = [OFFSET_SCALE**2 + DAILY_ORDER * SEASON_SCALE**2, SLOPE_SCALE**2]
    variance += [np.inf] * len(places)
    for period, order in _seasons(days):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * every / period
            columns += [np.sin(angle), np.cos(angle)]
            variance += [SEASON_SCALE**2] * 2
    design = np.column_stack(columns)
    history = design[:n]
    gram, moment, energy = history.T @ history, history.T @ y, float(y @ y)
    laplace = slice(2, 2 + len(places))
    ridge = np.diag(1 / np.array(variance))
    weights = np.zeros(design.shape[1])
    # Days that come twice may be two change points at one place, which only the exact search tells apart.
    reduced = len(places) >= REDUCED and np.diff(days).min() > 0
    curve = 1 / NOISE_SCALE**2

    def likely(rss: float) -> float:
        """Minimum of rss / (2 v) + n log(v) / 2 + v / (2 NOISE_SCALE ** 2) over the variance v."""
        return max(2 * rss / (n + np.sqrt(n * n + 4 * curve * rss)), LEAST_NOISE)

    def excess(noise: float, exact: bool = False) -> float:
        """By how much the best variance for the best weights exceeds the variance that they are for.

        Weights that the smaller system finds are right but for rounding; those of the result come from the exact search.
        """
        nonlocal weights
        # All in units of the noise, so that a tiny variance does not blow up the numbers.
        hessian, penalty = gram + noise * ridge, noise / CHANGE_SCALE
        reached = False
        if reduced:
            with contextlib.suppress(np.linalg.LinAlgError):
                found, reached = _first_changes(hessian, moment, laplace, penalty, weights)
                reached = reached and np.isfinite(found).all()
                weights = found if reached else weights
        if exact or not reached:
            weights = _slope_changes(hessian, moment, laplace, penalty, weights)
        rest = y - history @ weights
        return likely(float(rest @ rest)) - noise

    # Below this variance the best one is greater for any weights, so nothing need be fitted to know the side.
    sure = 0.0
    if reduced and n > design.shape[1]:
        least = energy - moment @ np.linalg.solve(gram + LEAST_NOISE * ridge, moment)
        sure = likely(max(least - 1e-3 * energy, 0.0) / 2)
    low, high = LEAST_NOISE, likely(energy)
    guess = min(0.25, high)
    at_guess = excess(guess)
    low, high, at_low, at_high = (low, guess, None, at_guess) if at_guess <= 0 else (guess, high, at_guess, None)
    noise, turn = guess, 0
    while at_guess and high - low > 1e-12 * high:
        turn += 1
        noise = np.sqrt(low * high)
        if turn % 3 and at_low is not None and at_high is not None:
            noise = low + (high - low) * at_low / (at_low - at_high)
        elif turn % 3 == 1 or turn % 3 and reduced and low > LEAST_NOISE:
            # One step of alternation stays on its side of the common point, as both sizes grow together; two most often pass it.
            noise = guess + (2 if reduced and low > LEAST_NOISE else 1) * at_guess
        noise = min(max(noise, low), high)
        if noise in (low, high) and turn % 3:
            continue
        if at_low is None and low < noise < sure:
            low = noise
            continue
        guess, at_guess = noise, excess(noise)
        if at_guess > 0:
            low, at_low = noise, at_guess
        else:
            high, at_high = noise, at_guess
        if noise in (low, high) and noise == LEAST_NOISE:
            break
    at_end = abs(excess(noise, exact=True)) / noise
    off = _violation(gram + noise * ridge, moment, laplace, noise / CHANGE_SCALE, weights)
    return design @ weights * scale, max(off, at_end)


def additive_fit_udf(periods: int):
    """Fitted values and the violation of the optimality conditions for array columns of day numbers and values; nulls where no fit exists."""

    @pandas_udf("fitted array<double>, violation double")
    def fit(days: pd.Series, values: pd.Series) -> pd.DataFrame:
        out = []
        for d, v in zip(days, values, strict=True):
            d, v = np.asarray(d, dtype=float), np.asarray(v, dtype=float)
            try:
                fitted, off = additive_fit(d, v, periods) if len(d) > 1 else (None, None)
            except np.linalg.LinAlgError:
                fitted, off = None, None
            usable = fitted is not None and np.isfinite(fitted).all()
            out.append((fitted, off) if usable else (None, None))
        return pd.DataFrame(out, columns=["fitted", "violation"])

    return fit
