"""Dates and amounts from text.  Every parser yields a value and a status."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

from .text import WHITESPACE, let, strip

# First and last day a nanosecond timestamp can hold.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"

# Month names and their first three letters in order.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH_NAME = (
    "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)(?:(?<=jan)uary|(?<=feb)ruary|(?<=mar)ch|"
    "(?<=apr)il|(?<=jun)e|(?<=jul)y|(?<=aug)ust|(?<=sep)t(?:ember)?|(?<=sep)tember|(?<=oct)ober|"
    "(?<=nov)ember|(?<=dec)ember)?"
)
_DAY_NAME = "(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?"
_TIME = (
    r"(?:t| +)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?: ?[ap]m)?"
    r" ?(?:z|utc|[+-]\d{2}:?\d{2})?$"
)
_JOIN = "\x01"  # joins the parts of a rewritten date, so that no later rewrite sees it
_YEAR = r"(\d{4}|\d{2})"


def parse_status(text: Column, parsed: Column) -> Column:
    """``empty`` for blank text, ``invalid`` for NULL or unparsable text, else ``ok``."""
    return (
        F.when(text.isNotNull() & (strip(text) == ""), "empty")
        .when(parsed.isNull(), "invalid")
        .otherwise("ok")
    )


def _date_shapes(today_year: int) -> list[tuple[str, str]]:
    """Patterns that rewrite a date text to year-month-day, each for one way of writing it."""
    century, short = divmod(today_year, 100)
    earlier = [f"{y:02d}" for y in range(100) if y >= short + 50]
    later = [f"{y:02d}" for y in range(100) if y < short - 50]
    shapes = [
        (r"^(\d{4})([-/. ])(\d{1,2})\2(\d{1,2})$", "$1-$3-$4"),
        (rf"^(1[3-9]|[2-9]\d)([-/.])(0?[1-9]|1[0-2])\2{_YEAR}$", "$4-$3-$1"),
        (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2{_YEAR}$", "$4-$1-$3"),
        (rf"^{_MONTH_NAME}\.?[ -](\d{{1,2}})(?:, ?|[ -]){_YEAR}$", "$3-$1-$2"),
        (rf"^(\d{{1,2}})[ -]{_MONTH_NAME}\.?(?:, ?|[ -]){_YEAR}$", "$3-$2-$1"),
        (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
        (r"^(\d{4})[-/](\d{1,2})$", "$1-$2-1"),
        (r"^(\d{1,2})[-/](\d{4})$", "$2-$1-1"),
        (rf"^{_MONTH_NAME}\.?,? (\d{{4}})$", "$2-$1-1"),
        (r"^(\d{4})$", "$1-1-1"),
    ]
    for years, first in ((earlier, century - 1), (later, century + 1)):
        if years:
            shapes.append((rf"^({'|'.join(years)}){_JOIN}", f"{first}$1-"))
    shapes.append((rf"^(\d\d){_JOIN}", f"{century}$1-"))
    return [(pattern, shape.replace("-", _JOIN)) for pattern, shape in shapes]


def parse_date(text: Column, today_year: int | None = None) -> Column:
    """Lenient date, month first; NULL when unparsable.

    Text that is not ISO yet goes through a chain of rewrites, each for one way of writing a
    date, and must come out as year-month-day; ``try_cast`` then rejects 30 February.  Month
    and day swap when the year comes last and the month is above 12.  A written time or zone
    must be valid and is dropped.  Two-digit years fall within 50 years of ``today_year``.
    Words such as "today" are not dates.
    """
    s = F.regexp_replace(F.lower(strip(text)), rf"^{_DAY_NAME},? +", "")
    s = F.regexp_replace(s, rf"(?<=\d){_TIME}", "")
    for pattern, shape in _date_shapes(today_year or datetime.date.today().year):
        s = F.regexp_replace(s, pattern, shape)
    for number, name in enumerate(_MONTHS, 1):
        s = F.replace(s, F.lit(f"{_JOIN}{name}{_JOIN}"), F.lit(f"{_JOIN}{number}{_JOIN}"))
    s = F.regexp_extract(s, rf"^\d{{4}}{_JOIN}\d{{1,2}}{_JOIN}\d{{1,2}}$", 0)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).otherwise(F.replace(s, F.lit(_JOIN), F.lit("-")))
    first, last = F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")
    return let(iso.try_cast("date"), lambda day: F.when((day >= first) & (day <= last), day))


def parse_cents(text: Column) -> Column:
    """Amount text as integer cents, half away from zero; NULL when unparsable.

    Brackets or a leading minus negate.  Thousands commas, the currency signs and "USD" are
    dropped.  What is left must look like a number: NaN, infinity and amounts beyond 64-bit
    cents are NULL.
    """
    blank = f"[{WHITESPACE}]*"
    bracket = "\x01"  # marks text that was in brackets
    s = F.regexp_replace(strip(text), r"(?s)^\((.*)\)$", f"{bracket}$1")
    s = F.replace(F.replace(F.translate(s, ",$€£₹_", ""), F.lit("USD")), F.lit("usd"))
    number = rf"^{blank}{bracket}?{blank}[-+]?{blank}([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?){blank}$"
    value = F.regexp_extract(s, number, 1).try_cast("decimal(38,18)")
    cents = F.round(value * F.lit(100).cast("decimal(3,0)"), 0).try_cast("bigint")
    sign = F.when(s.rlike(f"^{blank}(?:{bracket}|-)"), -1).otherwise(1)
    return cents * sign


def numeric(c: Column) -> Column:
    """Lenient number, NULL when the text is none."""
    s = strip(c.cast("string"))
    return F.when(s.rlike(r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$"), s).try_cast("double")
