"""Routing, acceptance rules, decision and record errors at request level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeline.config import PolicyConfig, Rule
from tradeline.functions.dates import AsOf, months_ago
from tradeline.operators.accounts import holds

Getter = Callable[[str], Column]


def is_recent_enquiry(date: Column, as_of: AsOf, cfg: PolicyConfig) -> Column:
    """Enquiry in the current or the previous three months; later dates count."""
    return holds(months_ago(date, as_of) <= cfg.enquiry_months)


def count_recent(enquiries: Column, as_of: AsOf, cfg: PolicyConfig) -> Column:
    """Recent enquiries of a nested list; 0 when no list was sent."""
    hits = F.filter(enquiries, lambda e: is_recent_enquiry(e["date"], as_of, cfg))
    return F.coalesce(F.array_size(hits), F.lit(0)).cast("bigint")


def is_thin_file(max_mob: Column, rows: Column, cfg: PolicyConfig) -> Column:
    """New to credit: at most one account row and it is young (or undated)."""
    young = F.coalesce(max_mob < cfg.thin_max_mob, F.lit(cfg.thin_when_undated))
    return young & (rows <= cfg.thin_max_rows)


def known_score(score: Column, cfg: PolicyConfig) -> Column:
    """The score, or the policy's stand-in when none was sent."""
    return F.coalesce(score, F.lit(cfg.missing_score))


def score_passes(score: Column, cfg: PolicyConfig) -> Column:
    return score >= cfg.min_score


def rule_outcome(rule: Rule, get: Getter) -> Column:
    """True when the rule passes. A ratio over zero fails."""
    value = get(rule.metric)
    if rule.per is not None:
        value = F.try_divide(value.cast("double"), get(rule.per).cast("double"))
    limit = F.lit(rule.limit)
    test = {
        ">": lambda: value > limit,
        "=": lambda: value == limit,
        "<=": lambda: value <= limit,
        "not >": lambda: ~holds(value > limit),
    }[rule.op]()
    return holds(test)


def rule_outcomes(get: Getter, cfg: PolicyConfig) -> dict[str, Column]:
    return {rule.name: rule_outcome(rule, get) for rule in cfg.rules}


def all_pass(get: Getter, cfg: PolicyConfig) -> Column:
    passed = F.lit(True)
    for rule in cfg.rules:
        passed = passed & get(rule.name)
    return passed


def flag_text(flag: Column) -> Column:
    """Boolean as ``True`` / ``False`` text."""
    return F.when(flag, "True").when(~flag, "False")


def accept_indicator(route: Column, n_usable: Column, accepted: Column) -> Column:
    """``True``/``False`` by the rules, ``0`` without a usable account.

    ``route`` is HIT, NOHIT or INVALID; a no-hit is accepted, bad input has no
    indicator.
    """
    return (
        F.when(route == "INVALID", F.lit(None).cast("string"))
        .when(route == "NOHIT", "True")
        .when(n_usable == 0, "0")
        .otherwise(flag_text(accepted))
    )


def history_status(route: Column, thin: Column) -> Column:
    """ETC has history, NTC new to credit, NA bad input."""
    return (
        F.when(route == "INVALID", "NA")
        .when((route == "NOHIT") | thin, "NTC")
        .otherwise("ETC")
    )


def missing_date(as_of: Column) -> Column:
    """The error of a request that should have its own decision date and has none; else null."""
    return F.when(as_of.isNull(), "MISSING_DATE")


def report_error(get: Getter, cfg: PolicyConfig) -> Column:
    """First failure found while reading the report of a HIT request, else null."""
    suit_known = get("any_suit")
    if cfg.suit_from_account:
        suit_known = suit_known | get("any_suit_status")
    reason = (
        F.when(holds(get("n_accounts") == 0) | ~holds(get("any_payment") & suit_known), "MISSING_HISTORY")
        .when(get("score").isNull(), "BAD_NUMBER")
    )
    if cfg.require_enquiry_summary:
        reason = reason.when(get("enquiry_summary").isNull(), "MISSING_ENQ_SUMMARY")
    return (
        reason.when(~get("any_balance"), "MISSING_FIELD")
        .when(get("bad_number"), "BAD_NUMBER")
        .when(get("null_tenure"), "NULL_TENURE")
        .when(get("null_report_date") & get("recent_report"), "NULL_REPORT_DATE")
        .when(get("future_report"), "FUTURE_REPORT_DATE")
        .when((get("n_usable") > 0) & ~get("any_acct_number"), "MISSING_FIELD")
        .when((get("n_usable") > 0) & get("reportnumber").isNull(), "NULL_REPORT_NUMBER")
    )
