"""Column functions for the legacy encodings. All take the trimmed text of a field
(see ``text_view``) and use built-in expressions only, so they run inside whole-stage
code generation. For whole tables use ``normalize``, which shares the steps between
fields and keeps the generated code small. None of them throws on bad input under ANSI mode and none depends on
the session time zone: calendar dates are checked by a string-to-date ``try_cast`` and
the output is assembled from the digits, never from an instant.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldnorm.spec import SENTINELS

# The accepted input encodings. `$` also matches before one final line
# break; an eight-digit date may not have one, so it ends with `\z`.
SHORT_DATE = r"^\d{6}$"  # yyMMdd
LONG_DATE = r"^\d{8}\z"  # yyyyMMdd
DASHED_DATE = r"^\d{4}-\d{2}-\d{2}($|[ T].*)"  # yyyy-MM-dd, any time part ignored
CLOCK = r"^([01]\d|2[0-3])[0-5]\d[0-5]\d"  # HHmmss, more may follow
PACKED_TIME = CLOCK + r"\d{2}$"  # HHmmssxx
WHOLE_NUMBER = r"^-?\d+$"
ZERO_FRACTION = r"\.0+$"
CODE = r"^\d{3,19}$"
CODE_SUFFIX = "00"

# Two-digit years below the pivot are 20yy, the rest 19yy.
YEAR_PIVOT = "70"

# The shapes of normalised text.
DATE_SHAPE = r"^\d{2}_\d{2}-\d{4}$"  # dd_MM-yyyy
TIMESTAMP_SHAPE = r"^\d{2}_\d{2}-\d{4} \d{2}:\d{2}:\d{2}$"  # dd_MM-yyyy HH:mm:ss
AMOUNT_SHAPE = r"^-?\d+\.\d{2}$"
SHORT_CODE_SHAPE = r"^\d{1,17}$"
SHORT_CODE_WIDTH = 17


def is_sentinel(text: Column, sentinels: Iterable[str] = SENTINELS) -> Column:
    return text.isin(*sentinels)


def iso_text(text: Column, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Rewrite any accepted date encoding to ``yyyy-MM-dd`` digits; null for anything else.

    Whether the digits are a calendar date is for ``as_date`` to say.
    """

    def part(start: int, length: int) -> Column:
        return F.substring(text, start, length)

    century = F.when(part(1, 2) < YEAR_PIVOT, "20").otherwise("19")
    dash = F.lit("-")
    return (
        F.when(is_sentinel(text, sentinels), None)
        .when(text.rlike(SHORT_DATE), F.concat(century, part(1, 2), dash, part(3, 2), dash, part(5, 2)))
        .when(text.rlike(LONG_DATE), F.concat(part(1, 4), dash, part(5, 2), dash, part(7, 2)))
        .when(text.rlike(DASHED_DATE), part(1, 10))
    )


def as_date(iso: Column) -> Column:
    """Calendar date of ``yyyy-MM-dd`` digits; null for impossible dates."""
    return iso.try_cast("date")


def date_layout(day: Column) -> Column:
    """A calendar date as ``dd_MM-yyyy``, rearranged from its ISO text; null stays null.

    Nothing here is conditional, so Spark computes the text (and the date) only once.
    """
    iso = day.cast("string")
    part = {name: F.substring(iso, *at) for name, at in (("day", (9, 2)), ("month", (6, 2)), ("year", (1, 4)))}
    return F.concat(part["day"], F.lit("_"), part["month"], F.lit("-"), part["year"])


def parse_date(text: Column, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Date from ``yyMMdd``, ``yyyyMMdd`` or ISO text; blanks, sentinels and junk give null."""
    return as_date(iso_text(text, sentinels))


def date_text(text: Column, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Any accepted date encoding as ``dd_MM-yyyy``."""
    return date_layout(parse_date(text, sentinels))


def clock_layout(time: Column, date_shown: Column) -> Column:
    """``dd_MM-yyyy`` and packed ``HHmmssxx`` joined to ``dd_MM-yyyy HH:mm:ss``."""
    hours, minutes, seconds = (F.substring(time, start, 2) for start in (1, 3, 5))
    return F.when(
        time.rlike(CLOCK),
        F.concat(date_shown, F.lit(" "), hours, F.lit(":"), minutes, F.lit(":"), seconds),
    )


def timestamp_text(time: Column, date: Column, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Packed time with its date column as ``dd_MM-yyyy HH:mm:ss``.

    The last two digits of the time are dropped. Null where the time is blank or out of
    range or the date is missing. Sentinels apply to the date only: a time of all zeros
    is midnight.
    """
    return clock_layout(time, date_text(date, sentinels))


def whole_units(text: Column) -> Column:
    """Digits of an amount without a harmless all-zero fraction."""
    return F.when(text.contains("."), F.regexp_replace(text, ZERO_FRACTION, "")).otherwise(text)


def as_minor_units(units: Column) -> Column:
    return units.try_cast("decimal(19,0)")


def amount_layout(units: Column) -> Column:
    """Minor units divided by 100, exactly, with two decimals."""
    return (as_minor_units(units) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(21,2)").cast("string")


def amount_text(text: Column) -> Column:
    """Amount in minor units as text with two decimals (``-5`` gives ``-0.05``).

    Up to 19 digits are exact. Run this on raw values only: an amount already converted
    to ``5.00`` reads as five minor units. A non-zero fraction would be rounded, which is
    why the source check has to pass first.
    """
    return amount_layout(whole_units(text))


def truncate_last_2(text: Column) -> Column:
    """Drop the last two characters; blank gives null."""
    return F.when(text != "", F.left(text, F.length(text) - 2))
