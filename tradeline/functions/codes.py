"""Bureau code -> severity lookups as literal map expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_map(table: dict[str, int]) -> Column:
    """A constant ``map<string,int>``; Catalyst folds it to one literal.

    Written as one SQL expression: a literal per call would cost a round trip to
    the JVM for each of the entries.
    """
    entries = ", ".join(f"{_quoted(code)}, {int(level)}" for code, level in table.items())
    return F.expr(f"map({entries})")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def code_level(code: Column, table: dict[str, int]) -> Column:
    """Severity of one code; unknown and missing codes give null."""
    return code_map(table)[code]


def code_levels(codes: Column, table: dict[str, int]) -> Column:
    """Severity of every code of an array, position by position."""
    lookup = code_map(table)
    return F.transform(codes, lambda code: lookup[code])


def has_level(codes: Column, table: dict[str, int], level: int) -> Column:
    """Whether an array holds a code of at least this severity.

    Equal to ``array_max(code_levels(codes)) >= level``, but as one hash probe
    per element that stays in generated code. Null when undecided.
    """
    severe = ", ".join(_quoted(code) for code, value in table.items() if value >= level)
    return F.arrays_overlap(codes, F.expr(f"array({severe})")) if severe else F.lit(False)
