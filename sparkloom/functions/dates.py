"""Date functions as Column expressions. Today is always a parameter."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIEST = 1995
#: Forms of free-text dates, tried in order after a leading weekday has gone.
FORMS = ["yyyy-MM-dd", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy", "M/d/yyyy", "yyyy/MM/dd", "yyyyMMdd"]
# Fixed value: dates printed in a text.
BODY_DATE = r"(?i)\b(\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{4}|\d{4}-\d{2}-\d{2})\b"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_date(text: Column) -> Column:
    """The calendar date that a text names, in the text's own offset; null if it names none. Partial dates are none."""
    flat = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,? ", "")
    # a time of day and what follows it do not matter
    day = _let(flat, lambda t: F.regexp_replace(F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2})[T ]\d{1,2}:\d{2}.*$", "$1"), r"^(\d{1,2} [A-Za-z]{3,9} \d{4}) \d{1,2}:\d{2}.*$", "$1"))
    return _let(day, lambda t: F.coalesce(*[F.to_date(F.try_to_timestamp(t, F.lit(f))) for f in FORMS]))


def sane(day: Column, as_of: date) -> Column:
    """A page's date: not before 1995, not after today; otherwise null."""
    return _let(day, lambda d: F.when((F.year(d) >= EARLIEST) & (d <= F.lit(as_of)), d))


def api_date(value: Column, as_of: date) -> Column:
    """The date of an API field: ten digits are seconds, thirteen milliseconds since 1970; texts name a year from 1995 to the next one."""

    def parsed(text: Column) -> Column:
        seconds = F.when(text.rlike(r"^\d{10}$"), text.cast("long")).when(text.rlike(r"^\d{13}$"), F.floor(text.cast("long") / 1000))
        named = _let(free_date(text), lambda d: F.when(F.year(d).between(EARLIEST, as_of.year + 1), d))
        return F.when(text.isin("", "0"), F.lit(None)).when(text.rlike(r"^(\d{10}|\d{13})$"), F.to_date(F.timestamp_seconds(seconds))).otherwise(named)

    return _let(F.trim(value.cast("string")), parsed)


def body_date(text: Column, as_of: date) -> Column:
    """The first date that the first 1500 characters print, if it is sane."""
    return sane(free_date(F.regexp_extract(F.substring(text, 1, 1500), BODY_DATE, 1)), as_of)


def week(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.to_date(F.date_trunc("week", day))


def shown(day: Column) -> Column:
    return F.date_format(day, "d MMM yyyy")


def since(day: Column, days: int, as_of: date) -> Column:
    """Whether a day lies within so many days before today."""
    return F.to_date(day) >= F.date_sub(F.lit(as_of), days)
