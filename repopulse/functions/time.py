"""Calendar rules. None of them depends on the session locale, and none on the session zone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, in calendar order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Year, then month and day or week and day, in extended or basic form.
_DATE = r"(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)"
# Hour, minute, second and fraction, in extended or basic form.
_CLOCK = r"(?:(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?|(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)"
_ZONE = r"(?:Z|([+-])(\d{2})(?::?([0-5]\d)(?::?([0-5]\d)(?:[.,]\d+)?)?)?)"
_ISO = rf"\A{_DATE}(?:(?s:.){_CLOCK}{_ZONE}?)?\z"
_PARTS = "|".join(f"${i}" for i in range(1, 22))

def weekday_number(timestamp: Column) -> Column:
    """0 for Monday to 6 for Sunday: a 4-byte grouping key in calendar order."""
    return F.weekday(F.to_date(timestamp))


def weekday_name_of(number: Column) -> Column:
    return F.element_at(F.array(*(F.lit(name) for name in WEEKDAYS)), number + 1)


def weekday_name(timestamp: Column) -> Column:
    return F.when(timestamp.isNotNull(), weekday_name_of(weekday_number(timestamp)))


def week_start(timestamp: Column) -> Column:
    """Date of the Monday of the week."""
    day = F.to_date(timestamp)
    return F.date_sub(day, F.weekday(day))


# The common extended shape. Its zone keeps to what any clock on earth shows; wider ones take the general form, and so
# do the two days from which a zone can lead out of the years 1 to 9999.
_COMMON = r"\A(?!0000|0001-01-01|9999-12-31)\d{4}-\d{2}-\d{2}[T ](?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-4]):?[0-5]\d)?\z"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _common(text: Column) -> Column:
    """Wall time of a text of the common shape, by plain expressions that Spark compiles."""
    sign = lambda back: F.substring(text, -back, 1).isin("+", "-")
    zone = F.when(sign(6), 6).when(sign(5), 5).when(F.endswith(text, F.lit("Z")), 1).otherwise(0)
    wall = F.substring(text, F.lit(1), F.length(text) - zone).try_cast("timestamp_ntz")
    hours = F.when(sign(6), F.substring(text, -5, 2)).otherwise(F.substring(text, -4, 2)).try_cast("int")
    seconds = 3600 * hours + 60 * F.substring(text, -2, 2).try_cast("int")
    ahead = F.when(sign(6), F.substring(text, -6, 1)).otherwise(F.substring(text, -5, 1)) == "+"
    shift = F.when(zone >= 5, F.when(ahead, -seconds).otherwise(seconds)).otherwise(0)
    return wall + F.make_dt_interval(secs=shift.cast("decimal(18,6)"))


def _general(text: Column) -> Column:
    """Wall time of a text of any of the forms; one pattern cuts it, and every part is bound once."""

    def moment(p: Column) -> Column:
        def part(*numbers: int) -> Column:
            """The first of the groups that is there, else ''."""
            return F.concat(*(F.get(p, F.lit(n - 1)) for n in numbers))

        def two(*numbers: int) -> Column:
            return F.lpad(part(*numbers), 2, "0")

        def week_day(fourth: Column) -> Column:
            monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (part(6, 8).try_cast("int") - 1) * 7)
            # The Thursday of a week lies in the year that the week belongs to.
            return _bound(
                monday,
                lambda m: F.when(
                    F.year(F.date_add(m, 3)) == part(1).try_cast("int"),
                    F.date_add(m, F.coalesce(part(7, 9).try_cast("int"), F.lit(1)) - 1),
                ),
            )

        day = F.concat_ws("-", part(1), two(2, 4), two(3, 5)).try_cast("date")
        by_week = _bound(F.concat(part(1), F.lit("-01-04")).try_cast("date"), week_day)
        date = F.when(part(1) != "0000", F.when(part(6, 8) != "", by_week).otherwise(day))
        clock = F.concat_ws(":", two(10, 14), two(11, 15), two(12, 16))
        fraction = F.rpad(part(13, 17), 6, "0")
        wall = F.concat(date.cast("string"), F.lit("T"), clock, F.lit("."), fraction).try_cast("timestamp_ntz")

        def shifted(hours: Column) -> Column:
            seconds = 3600 * hours + F.coalesce(60 * part(20).try_cast("int"), F.lit(0)) + F.coalesce(part(21).try_cast("int"), F.lit(0))
            shift = seconds * F.when(part(18) == "-", 1).otherwise(-1)
            return F.when(hours < 24, wall + F.make_dt_interval(secs=shift.cast("decimal(18,6)")))

        return _bound(F.coalesce(part(19).try_cast("int"), F.lit(0)), shifted)

    parts = F.split(F.regexp_replace(text, _ISO, _PARTS), r"\|", -1)
    return F.when(text.rlike(_ISO), _bound(parts, moment))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a UTC wall time, null when it is no such text.

    Dates and times may have separators or not, a date may be a week and a day of it, and a zone may
    be any shift below a day. A value without a zone is a UTC value. Digits of a fraction beyond the
    sixth are cut off. A time that its zone moves out of the years 1 to 9999 is null.

    The common extended shape is recognised first and read by plain expressions, outside any lambda, which
    would have them interpreted; only other texts meet the pattern of all forms. Patterns check the form, because Spark's own parser also takes a lone
    year, a lone clock time or one-digit parts.
    """
    general = _bound(_general(text), lambda t: F.when(F.year(t).between(1, 9999), t))
    return F.when(text.rlike(_COMMON), _common(text)).otherwise(general)
