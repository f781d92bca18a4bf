"""Native column expressions for the raw text and number encodings.

Each function takes and returns a ``Column`` made of built-in functions only, so
a projection that uses them stays inside whole-stage code generation. Every one
gives null for null and for malformed input, also with ANSI mode on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The encodings the raw feeds use.
WHITESPACE = " \t\n\r\f\v"
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DAY_ZERO = dt.date(1960, 1, 1)
MONTH_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def _date(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def number(text: Column) -> Column:
    """Decimal text as a double. Words such as ``nan`` or ``1.0d`` are no numbers."""
    body = stripped(text)
    return F.when(body.rlike(DECIMAL_TEXT), body.try_cast("double"))


def last_part(text: Column, separator: str = "-") -> Column:
    """The part after the last separator: ``US-PA`` gives ``PA``."""
    return F.substring_index(stripped(text), separator, -1)


def pair_part(text: Column, position: int, separator: str = ",") -> Column:
    """The number at a 1-based position of a list such as ``"-75.2, 39.9"``."""
    return number(F.try_element_at(F.split(text, separator), F.lit(position)))


def hemisphere_degrees(text: Column, positive: str) -> Column:
    """Degrees with a direction letter: ``42.59N`` is 42.59 when N is positive.

    Every other letter makes the value negative.
    """
    body = stripped(text)
    degrees = number(F.left(body, F.length(body) - 1))
    return F.when(F.right(body, F.lit(1)) == positive, degrees).otherwise(-degrees)


def days_to_date(days: Column, day_zero: dt.date = DAY_ZERO) -> Column:
    """Days since ``day_zero`` as a date; fractions are cut off toward zero.

    Days outside the years 1 to 9999 are null, as are NaN and infinities.
    """
    whole = days.try_cast("int")
    first = (dt.date.min - day_zero).days
    last = (dt.date.max - day_zero).days
    return F.when(whole.between(first, last), F.date_add(_date(day_zero), whole))


def text_to_date(text: Column) -> Column:
    """A date written as month, day and year in eight digits, such as ``10292016``.

    Anything else, such as ``D/S``, is null. Casting an ISO date is several times
    faster than parsing by a pattern, in particular for text that is no date.
    """
    year_in_range = text.try_cast("int") % 10000 > 0
    parts = [F.substring(text, start, length) for start, length in ((5, 4), (1, 2), (3, 2))]
    return F.when((F.length(text) == 8) & year_in_range, F.concat_ws("-", *parts).try_cast("date"))


def month_key(moment: Column) -> Column:
    """The partition key of a date or timestamp column, such as ``jan16``."""
    return F.lower(F.date_format(moment, "MMMyy"))


def month_key_of(day: dt.date) -> str:
    """The partition key of a run date."""
    return f"{MONTH_NAMES[day.month - 1]}{day.year % 100:02d}"


def months_between(first: dt.date, last: dt.date) -> list[str]:
    """The partition keys from the month of ``first`` to that of ``last``."""
    start, stop = first.year * 12 + first.month - 1, last.year * 12 + last.month - 1
    return [month_key_of(dt.date(m // 12, m % 12 + 1, 1)) for m in range(start, stop + 1)]


def key_text(*parts: Column) -> Column:
    """A natural key as one text.

    Each part carries its length, so no two different keys give the same text, and a null differs from every string.
    """
    texts = [
        F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("~"))
        for p in parts
    ]
    return F.concat_ws("|", *texts)


def text_key(text: Column, bits: int = 60) -> Column:
    """The first bits of the md5 digest of a text, 60 at most, as a bigint."""
    if not 1 <= bits <= 60:
        raise ValueError("a key has 1 to 60 bits")
    whole = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return whole if bits == 60 else F.shiftright(whole, 60 - bits)


def surrogate_key(*parts: Column) -> Column:
    """A bigint key of 60 bits that depends on the values of the natural key and nothing else."""
    return text_key(key_text(*parts))
