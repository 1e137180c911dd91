"""Policy data: code tables, thresholds, limit grids and behaviour profiles.

Everything a risk team may want to change lives in :class:`PolicyConfig`; the
operators only read it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Bureau payment-status code -> severity. Codes that are not
# listed (also ``*`` and null) count as "no information".
PAYMENT_CODES = {
    "000": 0, "01+": 1, "30+": 2, "60+": 3, "90+": 4, "120+": 5, "180+": 6,
    "360+": 7, "540+": 8, "720+": 9, "PWOS": 10, "RGM": 11, "SET": 12,
    "WOF": 13, "BK": 14, "RES": 15, "SPM": 16, "WDF": 17, "SF": 18, "SUB": 19,
    "DBT": 20, "CUF": 21,
    "CLSD": -1, "INAC": -3, "ADJ": -4, "STD": -5, "LOSS": -6, "RNC": -7,
    "LNSB": -8, "FPD": -9, "DIS": -12, "LAND": -13, "DEC": -15, "NEW": -17,
}

# Suit-filed code -> level.
SUIT_CODES = {"NS": -3, "*": -2, "SF": 1, "TP": 9, "DI": 10, "ED": 11}

# Asset-classification code -> level.
ASSET_CODES = {
    "STD": 1, "SUB": 2, "DBT": 3, "LOSS": 4, "SMA": 5, "NPA": 6,
    "SMA 0": 7, "SMA 1": 8, "SMA 2": 9, "DBT 1": 10, "DBT 2": 11, "DBT 3": 12,
}

# Lower score bound of each band; scores below the last are "G".
SCORE_BANDS = (("A", 900), ("B", 800), ("C", 700), ("D", 600), ("E", 500), ("F", 400))
LOWEST_BAND = "G"

# Fixed values: (min, max) monthly income bracket -> income band. A bracket has
# to match exactly; every other pair falls into the default band.
INCOME_BRACKETS = (
    (0, 0, 1), (0, 10000, 1), (10000, 25000, 2), (25000, 30000, 2),
    (30000, 40000, 3), (40000, 50000, 3), (50000, None, 4),
)
DEFAULT_INCOME_BAND = 1

# Score band -> value for income bands 1, 2, 3, 4.
LIMIT_MULTIPLIER = {
    "A": (1.15, 1.15, 1.25, 1.50),
    "B": (1.00, 1.00, 1.15, 1.25),
    "C": (0.80, 1.00, 1.15, 1.15),
    "D": (0.80, 0.80, 1.00, 1.15),
    "E": (0.75, 0.80, 1.00, 1.00),
    "F": (0.75, 0.75, 0.80, 1.00),
    "G": (0.65, 0.65, 0.75, 0.75),
}
LIMIT_CEILING = {
    "A": (1000, 2000, 3000, 4000),
    "B": (750, 1500, 2000, 3000),
    "C": (750, 1000, 1500, 2500),
    "D": (750, 1000, 1000, 2500),
    "E": (500, 750, 1000, 1500),
    "F": (500, 500, 750, 1000),
    "G": (500, 500, 500, 750),
}
LIMIT_FLOOR = {
    "A": (300, 500, 750, 1000),
    "B": (300, 500, 750, 1000),
    "C": (300, 500, 750, 750),
    "D": (300, 300, 500, 500),
    "E": (300, 300, 500, 500),
    "F": (300, 300, 300, 300),
    "G": (300, 300, 300, 300),
}


@dataclass(frozen=True)
class Rule:
    """``metric op limit`` passes; ``per`` turns the metric into a ratio."""

    name: str
    metric: str
    op: str
    limit: float | bool
    per: str | None = None


# The twelve acceptance rules, in report order.
ACCEPTANCE_RULES = (
    Rule("sum_perf_avail_dec", "sum_perf_avail", ">", 0),
    Rule("cnt_derog_accts_dec", "cnt_derog_accts", "=", 0),
    Rule("cnt_overdue_accts_dec", "cnt_overdue_accts", "<=", 1),
    Rule("cnt_dpd90_l12m_accts_dec", "cnt_dpd90_l12m_accts", "<=", 0),
    Rule("cnt_dpd60_l12m_accts_dec", "cnt_dpd60_l12m_accts", "<=", 1),
    Rule("cnt_dpd30_l6m_accts_dec", "cnt_dpd30_l6m_accts", "<=", 1),
    Rule("cnt_dpd30_l12m_accts_rt_dec", "cnt_dpd30_l12m_accts", "<=", 0.33, per="cnt_accts"),
    Rule("sum_dpd_ins_l12m_dec", "sum_dpd_ins_l12m", "<=", 5),
    Rule("sum_dpd_ins_l6m_dec", "sum_dpd_ins_l6m", "<=", 3),
    Rule("sum_dpd_ins_l3m_dec", "sum_dpd_ins_l3m", "<=", 0),
    Rule("max_inq_l3m_dec", "max_inq_l3m", "not >", 10),
    Rule("max_score_dec", "max_score", "=", True),
)


@dataclass(frozen=True)
class PolicyConfig:
    """One policy version. Build variants with :func:`dataclasses.replace`."""

    payment_codes: dict = None
    suit_codes: dict = None
    asset_codes: dict = None
    rules: tuple[Rule, ...] = ACCEPTANCE_RULES

    derog_max_mob: int = 48
    derog_payment: int = 5
    derog_asset: int = 4
    derog_suit: int = 0
    dpd30: int = 2
    dpd60: int = 3
    dpd90: int = 4
    min_score: int = 700
    missing_score: int = 99999
    enquiry_months: int = 3

    score_bands: tuple = SCORE_BANDS
    lowest_band: str = LOWEST_BAND
    income_brackets: tuple = INCOME_BRACKETS
    default_income_band: int = DEFAULT_INCOME_BAND
    limit_multiplier: dict = None
    limit_ceiling: dict = None
    limit_floor: dict = None
    limit_step: int = 100

    thin_max_mob: int = 6
    thin_max_rows: int = 1
    thin_when_undated: bool = True

    # Input and output shape.
    envelope: bool = True
    normalise_phone: bool = True
    suit_from_account: bool = True
    require_enquiry_summary: bool = False
    #: Fallbacks look at whether a key was sent at all; else a key that is null everywhere counts as absent.
    key_presence: bool = False
    user_column: str = "user_id"

    def __post_init__(self):
        for name, table in (
            ("payment_codes", PAYMENT_CODES),
            ("suit_codes", SUIT_CODES),
            ("asset_codes", ASSET_CODES),
            ("limit_multiplier", LIMIT_MULTIPLIER),
            ("limit_ceiling", LIMIT_CEILING),
            ("limit_floor", LIMIT_FLOOR),
        ):
            if getattr(self, name) is None:
                object.__setattr__(self, name, table)


#: Current policy: enveloped requests, limit computation, fixed output schema.
CURRENT = PolicyConfig()

#: First launch: bare report per file, no limit, undated reports are not thin.
LAUNCH = replace(
    CURRENT,
    envelope=False,
    normalise_phone=False,
    suit_from_account=False,
    thin_when_undated=False,
)
