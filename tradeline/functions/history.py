"""Look-back frames over a 48-month history array.

Position 0 of a raw history is the month the account was last reported. With
``lag`` = months from that report to the as-of date, raw position ``i`` is month
``L{i+lag}M`` of the applicant's calendar. Frames are array slices, so they cost
neither a window operator nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = 48  # months a history may cover
GRID = MONTHS + 1  # L0M .. L48M


def shift(lag: Column) -> Column:
    """Positions to shift; a report dated years ahead counts as current."""
    return F.when(lag < 0, F.lit(0)).otherwise(lag)


def pad(codes: Column, size: int = GRID) -> Column:
    """Extend with nulls (or cut) to exactly ``size`` positions."""
    return F.slice(F.concat(codes, F.array_repeat(F.lit(None), size)), 1, size)


def visible(codes: Column, lag: Column) -> Column:
    """The part of a raw history that falls on L0M..L47M (none without a lag)."""
    kept = F.greatest(F.lit(MONTHS) - shift(lag), F.lit(0))
    return F.slice(codes, F.lit(1), kept)


def lookback(seen: Column, lag: Column, months: int) -> Column:
    """Months L1M..L{months}M of a :func:`visible` history, as far as they exist."""
    return F.slice(seen, F.greatest(F.lit(2) - shift(lag), F.lit(1)), _length(lag, months))


def first_months(frame: Column, lag: Column, months: int) -> Column:
    """Months L1M..L{months}M of a longer :func:`lookback` frame."""
    return F.slice(frame, F.lit(1), _length(lag, months))


def _length(lag: Column, months: int) -> Column:
    """How many of L1M..L{months}M lie at or before the last report."""
    return F.greatest(F.least(F.lit(months), F.lit(months + 1) - shift(lag)), F.lit(0))


def reanchor(levels: Column, lag: Column) -> Column:
    """The full L0M..L48M array: leading nulls, then the visible part."""
    missing = F.lit(None).cast("int")
    lead = F.array_repeat(missing, F.least(shift(lag), F.lit(GRID)))
    return F.when(lag <= MONTHS, pad(F.concat(lead, visible(levels, lag)))).otherwise(
        F.array_repeat(missing, GRID)
    )


def long_form(codes: Column, lag: Column) -> Column:
    """``array<struct<k, code>>`` of the visible months, for exploding."""
    n = shift(lag)
    return F.transform(
        visible(codes, lag),
        lambda code, i: F.struct((i + n).alias("k"), code.alias("code")),
    )
