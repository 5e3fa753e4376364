"""Calendar-period fields, UTC discipline and ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_label(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def period_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "MM")


def period_end(day: Column | str) -> Column:
    return F.last_day(_col(day))


def month_index(day: Column | str) -> Column:
    """Months as a dense integer, so a calendar offset is a range frame."""
    return F.year(_col(day)) * 12 + F.month(_col(day))


def source_date(text: Column | str) -> Column:
    """Year-month-day text to date, null if it is anything else."""
    text = _col(text)
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), text.try_cast("date"))


# Fixed patterns: ISO-8601 dates and times as accepted for contract types.
_EXTENDED = r"(?!0000)\d{4}-\d{2}-\d{2}"
_BASIC = r"(?!0000)\d{8}"
_WEEK = r"(?!0000)(?:\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
_CLOCK = r"(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
_ZONE = r"(?:Z|[+-](?:\d{2}(?::\d{2}(?::\d{2})?)?|\d{4}(?:\d{2})?))"
_USUAL_MOMENT = rf"^{_EXTENDED}(?:[T ]\d{{2}}:\d{{2}}:\d{{2}}(?:\.\d{{1,6}})?(?:Z|[+-]\d{{2}}:\d{{2}})?)?$"
_MOMENT = rf"(?s)^(?:{_EXTENDED}|{_BASIC}|{_WEEK})(?:.{_CLOCK}(?:[:.,]?{_ZONE})?)?$"

# Rewrites that bring any accepted form to the one Spark casts: day, blank, full clock, +hh:mm.
_DAY = r"(?s)^(\d{4}-\d{2}-\d{2})"
_TO_USUAL = (
    (r"[:.,](?=[+-])", ""),
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (_DAY + r".(\d{2})(?=$|[+-])", "$1 $2:00:00"),
    (_DAY + r".(\d{2}):?(\d{2})(?=$|[+-])", "$1 $2:$3:00"),
    (_DAY + r".(\d{2})(\d{2})(\d{2})(?=$|[.,+-])", "$1 $2:$3:$4"),
    (_DAY + r".(\d{2}:\d{2}:\d{2})", "$1 $2"),
    (r"(:\d{2})[.,](\d{1,6})\d*", "$1.$2"),
    (r"( \S+[+-]\d{2})(\d{2})(\d{2})?$", "$1:$2:$3"),
    (r"( \S+[+-]\d{2}:\d{2}):(?:00)?$", "$1"),
    (r"( \S+[+-]\d{2})$", "$1:00"),
)


def iso_date(text: Column | str) -> Column:
    """Date from extended, basic or week-date ISO text; null if it is not one."""
    text = _col(text)
    dashed = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(text.rlike(rf"^(?:{_EXTENDED}|{_BASIC})$"), dashed.try_cast("date")).when(
        text.rlike(rf"^{_WEEK}$"), _week_date(text)
    )


def _week_date(text: Column) -> Column:
    """A week belongs to the year its Thursday falls in, which rules out week 53 of a short year."""
    year = F.substring(text, 1, 4)
    week = F.regexp_extract(text, r"W(\d{2})", 1).try_cast("int")
    day = F.coalesce(F.regexp_extract(text, r"W\d{2}-?([1-9])", 1).try_cast("int"), F.lit(1))
    weekday_fits = ~text.rlike(r"W\d{2}-?[089]")
    first_monday = F.trunc(F.concat(year, F.lit("-01-04")).try_cast("date"), "week")
    thursday = F.date_add(first_monday, (week - 1) * 7 + 3)
    fits = (week >= 1) & (F.year(thursday) == year.try_cast("int")) & weekday_fits
    return F.when(fits, F.date_add(first_monday, (week - 1) * 7 + day - 1))


def iso_instant(text: Column | str) -> Column:
    """Instant from ISO text with any separator; without an offset it is taken as UTC.

    The usual form is cast as it is; other forms are rewritten to it first. Offsets reach 18 hours.
    """
    given = _col(text)
    text = F.regexp_replace(given, "Z", "+00:00")
    after_week = F.regexp_replace(text, rf"^{_WEEK}", "")
    usual = F.when(text.rlike(rf"^{_WEEK}"), F.concat(_week_date(text).cast("string"), after_week)).otherwise(text)
    for pattern, replacement in _TO_USUAL:
        usual = F.regexp_replace(usual, pattern, replacement)
    return F.when(given.rlike(_USUAL_MOMENT), given.try_cast("timestamp")).when(
        text.rlike(_MOMENT), usual.try_cast("timestamp")
    )


def aware_instant(text: Column | str) -> Column:
    """Instant from text that names its zone; null for naive text, which must be rejected."""
    text = _col(text)
    return F.when(text.rlike(rf"\d[T ]{_CLOCK}{_ZONE}$"), iso_instant(text))
