"""Formulas that give the test tables the shape of bureau data.

The values are deterministic functions of keys, so the same data exist on both
engines. Text that reads the same in both SQL dialects is shared; the rest takes
the dialect. Only *data* come from here; what is computed on them is written
separately as DataFrame code and as plain SQL.
"""

from __future__ import annotations

import datetime as dt

AS_OF = dt.date(2024, 1, 31)
AS_OF_MONTH = AS_OF.year * 12 + AS_OF.month
SPARK, DUCK = "spark", "duck"


def idiv(a: str, b: int, dialect: str) -> str:
    return f"({a} div {b})" if dialect == SPARK else f"({a} // {b})"


def months_before(n: str, dialect: str) -> str:
    """First day of the month ``n`` months before the as-of date."""
    if dialect == SPARK:
        return f"add_months(DATE '2024-01-01', -CAST({n} AS INT))"
    return f"CAST(DATE '2024-01-01' - to_months(CAST({n} AS INTEGER)) AS DATE)"


def later_month(ts: str, n: int, dialect: str) -> str:
    """First day of the month ``n`` months after ``ts``."""
    if dialect == SPARK:
        return f"CAST(date_trunc('month', add_months(CAST({ts} AS DATE), {n})) AS DATE)"
    return f"CAST(date_trunc('month', {ts}) + INTERVAL {n} MONTH AS DATE)"


# --- requests ---------------------------------------------------------------


def route(k: str) -> str:
    return f"CASE WHEN {k} % 50 = 0 THEN 'INVALID' WHEN {k} % 50 = 1 THEN 'NOHIT' ELSE 'HIT' END"


def score(k: str) -> str:
    return f"CASE WHEN {k} % 13 = 0 THEN NULL ELSE 650 + ({k} * 37) % 250 END"


_BRACKETS = [
    ("{k} % 11 = 0", "0", "0"),
    ("{k} % 13 = 0", "1", "2"),
    ("{k} % 7 = 0", "40000", "50000"),
    ("{seg} = 'AUTOMOBILE'", "0", "10000"),
    ("{seg} = 'BUILDING'", "10000", "25000"),
    ("{seg} = 'FURNITURE'", "25000", "30000"),
    ("{seg} = 'HOUSEHOLD'", "30000", "40000"),
]


def min_income(k: str, seg: str) -> str:
    arms = " ".join(f"WHEN {w.format(k=k, seg=seg)} THEN {lo}" for w, lo, _ in _BRACKETS)
    return f"CAST(CASE {arms} ELSE 50000 END AS DOUBLE)"


def max_income(k: str, seg: str) -> str:
    arms = " ".join(f"WHEN {w.format(k=k, seg=seg)} THEN {hi}" for w, _, hi in _BRACKETS)
    return f"CAST(CASE {arms} ELSE NULL END AS DOUBLE)"


def limit_score(k: str) -> str:
    return f"CAST(({k} * 37) % 1001 AS DOUBLE)"


def base_limit(balance: str) -> str:
    return f"greatest({balance}, CAST(0 AS DOUBLE)) / 2"


# --- accounts from orders ---------------------------------------------------


def opened(k: str, a: str, ordered: str, dialect: str) -> str:
    recent = months_before(f"({idiv(k, 50, dialect)} % 12)", dialect)
    return (
        f"CASE WHEN {k} % 50 = 3 OR {a} % 89 = 0 THEN NULL WHEN {k} % 50 = 2 THEN {recent} "
        f"ELSE {later_month(ordered, 264, dialect)} END"
    )


def payment(k: str, a: str, i: str) -> str:
    return (
        f"CASE WHEN {k} % 20 = 7 AND {i} < 24 AND {a} % 3 <> 0 THEN '60+' "
        f"WHEN {a} % 151 = 0 AND {i} = 20 THEN 'SUB' WHEN {a} % 157 = 0 AND {i} = 7 THEN '90+' "
        f"WHEN {a} % 61 = 0 AND {i} = 4 THEN '60+' "
        f"WHEN {a} % 31 = 0 AND {i} % 5 = 0 AND {i} < 15 THEN '30+' "
        f"WHEN {a} % 9 = 0 AND {i} = 0 THEN '01+' WHEN {i} % 17 = 3 THEN '*' "
        f"WHEN {i} % 23 = 5 THEN 'ZZZ' WHEN {i} % 11 = 7 THEN NULL "
        f"WHEN {a} % 5 = 0 THEN 'STD' ELSE '000' END"
    )


def suit(a: str, i: str) -> str:
    return f"CASE WHEN {a} % 211 = 0 AND {i} = 5 THEN 'SF' WHEN {i} % 3 = 0 THEN 'NS' ELSE '*' END"


def asset(a: str, i: str) -> str:
    return (
        f"CASE WHEN {a} % 223 = 0 AND {i} = 10 THEN 'LOSS' "
        f"WHEN {a} % 41 = 0 AND {i} = 2 THEN 'DBT' ELSE 'STD' END"
    )


def marked(k: str, a: str) -> str:
    """Whether a code of the account's histories depends on more than the place and ``a % 5``."""
    rare = " OR ".join(f"{a} % {n} = 0" for n in (151, 157, 61, 31, 9, 211, 223, 41))
    return f"({k} % 20 = 7 OR {rare})"


def coded(code: str, table: dict[str, int]) -> str:
    """Code -> severity as a SQL CASE."""
    arms = " ".join(f"WHEN '{c}' THEN {v}" for c, v in table.items())
    return f"CASE {code} {arms} END"


# --- accounts inside request documents --------------------------------------
# ``a`` is the account key k * 5 + j; ``v`` is k % 97 and picks odd documents.


def doc_accounts(k: str, dialect: str) -> str:
    return f"CASE WHEN {k} % 89 = 88 THEN 0 ELSE 1 + {idiv(k, 2, dialect)} % 4 END"


def doc_opened(k: str, a: str, dialect: str) -> str:
    """Opening day, null when unreadable or absent."""
    fresh = months_before(f"({idiv(k, 7, dialect)} % 12)", dialect)
    old = months_before(f"(12 + {a} % 70)", dialect)
    day = f"CAST({a} % 28 AS INT)"
    return (
        f"CASE WHEN {a} % 29 = 0 OR {a} % 31 = 0 THEN NULL "
        f"WHEN {k} % 7 = 2 THEN {fresh} + {day} ELSE {old} + {day} END"
    )


def doc_lag(k: str, a: str, j: str) -> str:
    """Months since the last report; null = no report date."""
    v = f"({k} % 97)"
    return (
        f"CASE WHEN {v} = 61 OR ({v} IN (37, 41) AND {j} = 0) THEN NULL "
        f"WHEN {v} = 43 AND {j} = 0 THEN -2 WHEN {v} = 73 AND {j} = 0 THEN -60 "
        f"ELSE {a} % 53 END"
    )


def doc_closed_ago(k: str, a: str, j: str) -> str:
    """Months since closing; null = open."""
    v = f"({k} % 97)"
    return (
        f"CASE WHEN {v} = 37 AND {j} = 0 THEN NULL "
        f"WHEN {v} = 61 OR ({v} = 41 AND {j} = 0) THEN 3 "
        f"WHEN {a} % 3 = 0 THEN {a} % 53 ELSE NULL END"
    )
