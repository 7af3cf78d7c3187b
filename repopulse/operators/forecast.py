"""Daily series per repository and their forecasts.

A series is one row: the counts per day are aggregated first (partial on the map side), then the
days of a repository are gathered into an array. That array holds at most one entry per calendar
day, however many discussions a repository has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.series import SETTLED, additive_fit_udf, holt_fit, holt_fold
from repopulse.operators.activity import daily_by_repo_id

CREATED_DAYS = 14
SMOOTHED_DAYS = 7


def created(discussions: DataFrame) -> DataFrame:
    return daily_by_repo_id(discussions, "created_at")


def closed(discussions: DataFrame) -> DataFrame:
    return daily_by_repo_id(discussions.filter(F.col("status") == "closed"), "closed_at")


def pull_requests(discussions: DataFrame) -> DataFrame:
    return daily_by_repo_id(discussions.filter("is_pull_request"), "created_at")


def daily_series(repos: DataFrame, daily: DataFrame) -> DataFrame:
    """``model_id`` and ``points``: day, count pairs in order of time. Days without counts are absent.

    Fitting costs far more than the few bytes of a series suggest, so the number of partitions is
    named; otherwise adaptive execution would merge them by size into a handful of tasks. Names are
    attached to the daily counts, so that no later join moves the series out of these partitions.
    """
    point = F.struct("day", F.col("daily_discussions").cast("double").alias("value"))
    names = repos.select(F.col("id").alias("repo_id"), "model_id")
    partitions = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        daily.join(names, "repo_id")
        .repartition(partitions, "model_id")
        .groupBy("model_id")
        .agg(F.sort_array(F.collect_list(point)).alias("points"))
    )


def _actual(points: Column) -> Column:
    return F.transform(
        points,
        lambda p: F.struct(
            F.lit("actual").alias("kind"), p["day"].alias("day"), F.lit(None).cast("int").alias("step"), p["value"].alias("value")
        ),
    )


def _forecast(days: Column, steps: Column, values: Column) -> Column:
    return F.transform(
        F.arrays_zip(days.alias("day"), steps.alias("step"), values.alias("value")),
        lambda f: F.struct(
            F.lit("forecast").alias("kind"), f["day"].alias("day"), f["step"].cast("int").alias("step"), f["value"].alias("value")
        ),
    )


def _long(rows: DataFrame, usable: Column, actual: Column, forecast: Column) -> DataFrame:
    """Actual and forecast values as rows ``model_id, kind, day, step, value``, from one pass.

    Series that are not ``usable`` make no rows. This is not a filter, which the optimizer would
    push below the fit together with a second copy of it.
    """
    return rows.select("model_id", F.inline(F.when(usable, F.concat(actual, forecast))))


def _ahead(points: Column, periods: int) -> tuple[Column, Column]:
    last = F.element_at(points, -1)["day"]
    steps = F.sequence(F.lit(1), F.lit(periods))
    return F.transform(steps, lambda s: F.date_add(last, s)), steps


# --- exponential smoothing with additive trend --------------------------------------------------


def _smoothed(fitted: DataFrame, usable: Column, periods: int) -> DataFrame:
    days, steps = _ahead(F.col("points"), periods)
    values = F.transform(steps, lambda s: F.col("final.level") + s * F.col("final.trend"))
    return _long(fitted, usable, _actual(F.col("points")), _forecast(days, steps, values))


def holt_fixed(series: DataFrame, alpha: float, beta: float, periods: int = SMOOTHED_DAYS) -> DataFrame:
    """Forecast with given parameters, started at the first value with no trend."""
    values = F.transform("points", lambda p: p["value"])
    start = F.element_at("points", 1)["value"]
    final = holt_fold(values, F.lit(float(alpha)), F.lit(float(beta)), start, F.lit(0.0))
    return _smoothed(series.filter(F.size("points") >= 3).withColumn("final", final), F.lit(True), periods)


def holt_fits(series: DataFrame) -> DataFrame:
    """Series with fitted parameters, final state and status; too short ones have no fit."""
    values = F.transform("points", lambda p: p["value"])
    long_enough = F.size("points") >= 3
    fitted = series.withColumn("fit", holt_fit(values))
    final = holt_fold(values, F.col("fit.alpha"), F.col("fit.beta"), F.col("fit.level"), F.col("fit.trend"))
    # A series without a usable fit comes back from Arrow as null, or as NaN from the fold.
    usable = F.coalesce(~F.isnan("final.level") & ~F.isnan("final.trend"), F.lit(False)) & F.col("final.level").isNotNull()
    return fitted.withColumn("final", F.when(long_enough, final)).withColumn(
        "status", F.when(~long_enough, "too short").when(usable, "ok").otherwise("failed")
    )


def holt_forecast(series: DataFrame, periods: int = SMOOTHED_DAYS) -> DataFrame:
    """Forecast with the parameters of least squared error on stated grids, and the start values that are
    best for them; three points are needed."""
    usable = series.filter(F.size("points") >= 3)
    return _smoothed(holt_fits(usable), F.col("status") == "ok", periods)


# --- trend and seasonality ----------------------------------------------------------------------


def additive_fits(series: DataFrame, periods: int = CREATED_DAYS) -> DataFrame:
    """Series with fitted values over history and horizon, status, and the violation of the optimality conditions.

    A fit that is no optimum to six digits is kept out of forecasts and named in the report.
    """
    days = F.transform("points", lambda p: F.unix_date(p["day"]))
    values = F.transform("points", lambda p: p["value"])
    return (
        series.withColumn("_fit", additive_fit_udf(periods)(days, values))
        .withColumns({"fitted": F.col("_fit.fitted"), "violation": F.col("_fit.violation")})
        .withColumn(
            "status",
            F.when(F.size("points") < 2, "too short")
            .when(F.col("fitted").isNull(), "failed")
            .when(F.col("violation") > SETTLED, "not converged")
            .otherwise("ok"),
        )
        .drop("_fit")
    )


def additive_forecast(series: DataFrame, periods: int = CREATED_DAYS) -> DataFrame:
    """Trend and seasonality forecast of series with two points or more; fitted days have step 0."""
    fits = additive_fits(series.filter(F.size("points") >= 2), periods)
    ahead, steps = _ahead(F.col("points"), periods)
    past = F.transform("points", lambda p: p["day"])
    no_step = F.transform("points", lambda p: F.lit(0))
    forecast = _forecast(F.concat(past, ahead), F.concat(no_step, steps), F.col("fitted"))
    return _long(fits, F.col("status") == "ok", _actual(F.col("points")), forecast)


def weekday_trend_forecast(repos: DataFrame, daily: DataFrame, periods: int = CREATED_DAYS) -> DataFrame:
    """Straight line by least squares plus the mean residual of each weekday, for two points or more.

    Days are counted from a fixed date and shifted to each repository's first day afterwards, so the
    sums and the days themselves come from one grouped aggregate, a row per repository: history and
    fit share a shuffle and nothing is joined back. The days of a repository are at most one entry
    per calendar day. Sums of whole numbers are exact, whatever day they are counted from.
    """
    timed = daily.select(
        "repo_id",
        "day",
        F.col("daily_discussions").cast("double").alias("y"),
        F.weekday("day").alias("w"),
        F.unix_date("day").cast("double").alias("a"),
    )
    a, y, one = F.col("a"), F.col("y"), F.lit(1.0)
    sums = {"n": one, "sa": a, "sy": y, "saa": a * a, "say": a * y}
    for i in range(7):
        on_day = F.col("w") == i
        sums |= {f"{name}{i}": F.when(on_day, c).otherwise(0.0) for name, c in (("n", one), ("sa", a), ("sy", y))}
    summed = timed.groupBy("repo_id").agg(
        F.min("day").alias("first"),
        F.max("day").alias("last"),
        F.collect_list(F.struct("day", "y")).alias("points"),
        *(F.sum(c).alias(name) for name, c in sums.items()),
    )
    zero = F.unix_date("first").cast("double")
    n, sa, sy = F.col("n"), F.col("sa"), F.col("sy")
    shifted = summed.filter("n >= 2").withColumns(
        {
            "st": sa - n * zero,
            "stt": F.col("saa") - 2 * zero * sa + n * zero * zero,
            "sty": F.col("say") - zero * sy,
            **{f"st{i}": F.col(f"sa{i}") - F.col(f"n{i}") * zero for i in range(7)},
        }
    )
    st = F.col("st")
    slope = (n * F.col("sty") - st * sy) / (n * F.col("stt") - st * st)
    fitted = shifted.withColumn("slope", slope).withColumn("base", (sy - F.col("slope") * st) / n)

    def residual(i: int) -> Column:
        rest = F.col(f"sy{i}") - F.col("base") * F.col(f"n{i}") - F.col("slope") * F.col(f"st{i}")
        return F.coalesce(rest / F.nullif(F.col(f"n{i}"), F.lit(0.0)), F.lit(0.0))

    names = repos.select(F.col("id").alias("repo_id"), "model_id")
    fitted = fitted.select(
        "repo_id", "first", "last", "points", "slope", "base", F.array(*(residual(i) for i in range(7))).alias("season")
    ).join(names, "repo_id")

    def row(kind: str, day: Column, step: Column, value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), day.alias("day"), step.cast("int").alias("step"), value.alias("value")
        )

    def at(day: Column) -> Column:
        return F.col("base") + F.col("slope") * F.datediff(day, "first") + F.element_at("season", F.weekday(day) + 1)

    past = F.flatten(
        F.transform(
            "points",
            lambda p: F.array(row("actual", p["day"], F.lit(None), p["y"]), row("forecast", p["day"], F.lit(0), at(p["day"]))),
        )
    )
    ahead = [F.date_add("last", h) for h in range(1, periods + 1)]
    horizon = F.array(*(row("forecast", day, F.lit(h), at(day)) for h, day in enumerate(ahead, 1)))
    return fitted.select("model_id", F.inline(F.concat(past, horizon)))


def fit_report(fits: DataFrame) -> DataFrame:
    """One row per series: number of days and whether it was fitted, so that no series is lost silently."""
    return fits.select("model_id", F.size("points").alias("points"), "status")
