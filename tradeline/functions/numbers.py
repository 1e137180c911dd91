"""Lenient number parsing that never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def to_double(text: Column) -> Column:
    """Text to double. Unreadable text gives null; see :func:`is_bad_number`."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_amount(text: Column) -> Column:
    """Text to double where "nan" means missing (it must not compare as a number)."""
    value = to_double(text)
    return F.when(~F.isnan(value), value)


def is_bad_number(text: Column) -> Column:
    """A value was sent, but it is not a number."""
    return text.isNotNull() & ~text.rlike(_NUMBER)


def to_whole(text: Column) -> Column:
    """Text to bigint; only plain whole numbers are accepted."""
    return F.when(text.rlike(_WHOLE), F.trim(text).try_cast("bigint"))
