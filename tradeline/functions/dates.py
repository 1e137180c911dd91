"""Lenient date parsing and calendar-month arithmetic.

Bureau files mix ISO dates with day-first and month-first spellings. A value is
first rewritten to ``yyyy-M-d[ time]`` by one CASE and then cast once with
``try_cast``, so an unreadable value is null instead of a failed task, and ISO
input (the usual case) pays for a single pattern test.

``as_of`` is one date for all rows, or a date column that gives each request its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years a date may have; anything else (a 9999 "never") is unreadable.
_YEAR = r"(167[89]|16[89]\d|1[789]\d\d|2[01]\d\d|22[0-5]\d|226[01])"
_SEP = r"[-/. ]"
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
_TIME = rf"(?:[ T]+({_CLOCK}))?$"
_HALF_DAY = r"^(.*\D)(0?[1-9]|1[0-2])(:\d{2}(?::\d{2}(?:\.\d{1,9})?)?) *([AaPp])\.?[Mm]\.?$"
_DAY, _MONTH, _NO_MONTH = r"(\d{1,2})", r"(0?[1-9]|1[0-2])", r"(1[3-9]|[2-9]\d)"

_ISO = rf"^{_YEAR}-\d{{1,2}}(-\d{{1,2}}([ T].*)?)?$"
_YEAR_FIRST = rf"^{_YEAR}[/. ](\d{{1,2}})[/. ](\d{{1,2}})"
_COMPACT = rf"^{_YEAR}(\d{{2}})(\d{{2}})$"
_COMPACT_TIME = rf"^{_YEAR}(\d{{2}})(\d{{2}})[ T]?(\d{{2}})(\d{{2}})(\d{{2}})$"
_DAY_NAME = rf"^(\d{{1,2}}){_SEP}*([A-Za-z]{{3}})[a-z]*[-/., ]*{_YEAR}{_TIME}"
_NAME_DAY = rf"^([A-Za-z]{{3}})[a-z]*{_SEP}*(\d{{1,2}})[-/., ]+{_YEAR}{_TIME}"
_SHORT_YEAR = rf"^(\d{{1,2}}{_SEP}\d{{1,2}}{_SEP})(\d\d)(?=$|[ T])"
_MONTH_NAMES = "janfebmaraprmayjunjulaugsepoctnovdec"


#: The decision date: one for the whole job, or a column.
AsOf = dt.date | Column


def per_request(as_of: AsOf) -> bool:
    """Whether every request has a date of its own."""
    return isinstance(as_of, Column)


def month_number(as_of: AsOf) -> Column:
    """Months since year zero of the reference date; a plain number for one date."""
    return month_index(as_of) if per_request(as_of) else F.lit(as_of.year * 12 + as_of.month)


def month_index(ts: Column) -> Column:
    """Months since year zero of a date column."""
    return F.year(ts) * 12 + F.month(ts)


def months_ago(ts: Column, as_of: AsOf) -> Column:
    """Calendar months from ``ts`` to ``as_of`` (days are ignored)."""
    return month_number(as_of) - month_index(ts)


def tenure_months(end: Column, opened: Column) -> Column:
    """Tenure as the policy defines it: true difference plus twice the opening month."""
    return month_index(end) - (F.year(opened) * 12 - F.month(opened))


def _named_month(name: Column) -> Column:
    at = F.instr(F.lit(_MONTH_NAMES), F.lower(name))
    return F.when(at % 3 == 1, ((at + 2) / 3).cast("int").cast("string"))


def _full_year(text: Column, as_of: AsOf) -> Column:
    """``3/4/23`` -> ``3/4/2023``, in the century closest to ``as_of``."""
    short = F.regexp_extract(text, _SHORT_YEAR, 2).try_cast("int")
    year = F.year(as_of) if per_request(as_of) else F.lit(as_of.year)
    century = F.when(short + 2000 >= year + 50, "19").otherwise("20")
    return F.concat(
        F.regexp_extract(text, _SHORT_YEAR, 1), century, F.regexp_replace(text, _SHORT_YEAR, "$2")
    )


def _written(text: Column, day_first: bool) -> Column:
    """Rewrite any known spelling to ``yyyy-M-d[ time]``; null when there is none."""
    if day_first:
        usual, swapped = (_DAY, _MONTH, "$3-$2-$1 $4"), (_DAY, _NO_MONTH, "$3-$1-$2 $4")
    else:
        usual, swapped = (_MONTH, _DAY, "$3-$1-$2 $4"), (_NO_MONTH, _DAY, "$3-$2-$1 $4")
    rewrites = [
        (f"^{first}{_SEP}{second}{_SEP}{_YEAR}{_TIME}", to) for first, second, to in (usual, swapped)
    ]
    rewrites += [(_YEAR_FIRST, "$1-$2-$3"), (_COMPACT, "$1-$2-$3")]
    rewrites.append((_COMPACT_TIME, "$1-$2-$3 $4:$5:$6"))
    found = F.when(text.rlike(_ISO), text)
    for pattern, to in rewrites:
        found = found.when(text.rlike(pattern), F.regexp_replace(text, pattern, to))
    dash = F.lit("-")
    for pattern, day, name in ((_DAY_NAME, 1, 2), (_NAME_DAY, 2, 1)):
        part = lambda i: F.regexp_extract(text, pattern, i)  # noqa: B023, E731
        found = found.when(
            text.rlike(pattern),
            F.concat(
                part(3), dash, _named_month(part(name)), dash, part(day),
                F.when(part(4) != "", F.concat(F.lit(" "), part(4))).otherwise(""),
            ),
        )
    return found


def _whole_day(text: Column) -> Column:
    """``10:00 PM`` -> ``22:00``; a text without AM or PM stays as it is."""
    part = lambda i: F.regexp_extract(text, _HALF_DAY, i)
    hour = part(2).try_cast("int") % 12 + F.when(F.lower(part(4)) == "p", 12).otherwise(0)
    return F.when(text.rlike(_HALF_DAY), F.concat(part(1), hour.cast("string"), part(3))).otherwise(text)


def parse_date(text: Column, as_of: AsOf, day_first: bool) -> Column:
    """Parse one date string to ``timestamp_ntz``; null when unreadable.

    ``day_first`` decides spellings such as ``03/04/2023``; when the preferred
    order is impossible (``12/31/2023``) the other one is used. Two-digit years
    go to the century closest to ``as_of``. Years outside 1678..2261 are null.
    """
    t = _whole_day(F.trim(text))
    written = F.coalesce(
        _written(t, day_first),
        F.when(t.rlike(_SHORT_YEAR), _written(_full_year(t, as_of), day_first)),
    )
    return written.try_cast("timestamp_ntz")


def date_text(ts: Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text, the form used in JSON output."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
