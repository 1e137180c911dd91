"""Account-level policy features.

Each stage is a function ``get -> {name: Column}`` where ``get(name)`` yields a
field of the previous stage. The same stage therefore runs

* over an account *table* (``get = F.col``), see :mod:`tradeline.plans.ledger`;
* inside ``transform(accounts, x -> ...)`` of a request document
  (``get = x.getField``), see :mod:`tradeline.plans.documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline.config import PolicyConfig
from tradeline.functions import history as h
from tradeline.functions.codes import code_level, code_levels, has_level
from tradeline.functions.dates import AsOf, months_ago

Getter = Callable[[str], Column]
Stage = Callable[[Getter, PolicyConfig, AsOf], dict[str, Column]]


def holds(condition: Column) -> Column:
    """Missing values compare as false."""
    return F.coalesce(condition, F.lit(False))


def placed(get: Getter, cfg: PolicyConfig, as_of: AsOf) -> dict[str, Column]:
    """Reporting lag and months on book."""
    return {
        "lag": months_ago(get("reported"), as_of),
        "mob": months_ago(get("opened"), as_of),
        "dpd": code_level(F.get(get("payment"), F.lit(0)), cfg.payment_codes),
    }


def coded(get: Getter, cfg: PolicyConfig, as_of: AsOf) -> dict[str, Column]:
    """Severe codes in the visible months; severities of the last twelve."""
    lag = get("lag")

    def severe(series: str, table: dict[str, int], level: int) -> Column:
        return holds(has_level(h.visible(get(series), lag), table, level))

    last_year = h.lookback(h.visible(get("payment"), lag), lag, 12)
    return {
        "severe_payment": severe("payment", cfg.payment_codes, cfg.derog_payment),
        "severe_asset": severe("asset", cfg.asset_codes, cfg.derog_asset),
        "severe_suit": severe("suit", cfg.suit_codes, cfg.derog_suit),
        "last_12": code_levels(last_year, cfg.payment_codes),
    }


def framed(get: Getter, cfg: PolicyConfig, as_of: AsOf) -> dict[str, Column]:
    """Worst severity and months late in the last 12, 6 and 3 completed months."""

    def late(months: int) -> Column:
        frame = h.first_months(get("last_12"), get("lag"), months)
        hits = F.array_size(F.filter(frame, lambda v: v >= cfg.dpd30))
        return F.coalesce(hits, F.lit(0))

    return {
        "worst_12": F.array_max(get("last_12")),
        "dpd30_pol_l12m_cnt": late(12),
        "dpd30_pol_l6m_cnt": late(6),
        "dpd30_pol_l3m_cnt": late(3),
    }


def flagged(get: Getter, cfg: PolicyConfig, as_of: AsOf) -> dict[str, Column]:
    """The account flags of the policy."""
    return {
        "perf_avail": holds(get("lag") <= h.MONTHS),
        "derog_pol": (
            holds((get("mob") <= cfg.derog_max_mob) & (get("writeoff") > 0))
            | get("severe_payment")
            | get("severe_asset")
            | get("severe_suit")
        ),
        "act_acct_pol": holds(get("balance") > 0) & holds(get("dpd") > 0),
        "dpd90_pol_l12m": holds(get("worst_12") >= cfg.dpd90),
        "dpd60_pol_l12m": holds(get("worst_12") >= cfg.dpd60),
        "dpd30_pol_l6m": get("dpd30_pol_l6m_cnt") > 0,
        "dpd30_pol_l12m": get("dpd30_pol_l12m_cnt") > 0,
    }


def together(*stages: Stage) -> Stage:
    """Several cheap stages in one pass; later ones may use fields of earlier ones."""

    def run(get: Getter, cfg: PolicyConfig, as_of: AsOf) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for stage in stages:
            out.update(stage(lambda n: out[n] if n in out else get(n), cfg, as_of))
        return out

    return run


STAGES: tuple[Stage, ...] = (placed, coded, framed, flagged)

# Stage outputs that later stages and sinks do not need.
SCRATCH = ("last_12", "worst_12", "severe_payment", "severe_asset", "severe_suit")


def opened_known(get: Getter) -> Column:
    return get("opened").isNotNull()


def usable(get: Getter) -> Column:
    """Only accounts with an open date count, and they need a reporting month."""
    return opened_known(get) & get("lag").isNotNull()


AVAILABLE, UNAVAILABLE = "available", "unavailable"


def availability(lag: Column) -> Column:
    """Whether any month of the history is still visible; null without a reporting month."""
    return F.when(lag <= h.MONTHS, AVAILABLE).when(lag > h.MONTHS, UNAVAILABLE)


# name -> (how to combine, contribution of one account). The sums feed the
# rules; the rest decides routing and record errors.
def contributions(get: Getter) -> dict[str, tuple[str, Column]]:
    dated = opened_known(get)
    counted = usable(get)

    def total(value: Column) -> tuple[str, Column]:
        return "sum", F.when(counted, value.cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    one = F.lit(1).cast("bigint")
    return {
        "n_accounts": ("sum", one),
        "n_dated": ("sum", dated.cast("bigint")),
        "n_usable": ("sum", counted.cast("bigint")),
        "max_mob": ("max", get("mob")),
        "bad_number": ("any", holds(get("bad_number"))),
        "null_tenure": ("any", dated & get("closed").isNull() & get("reported").isNull()),
        "null_report_date": ("any", dated & get("lag").isNull()),
        "recent_report": ("any", dated & holds(get("lag") <= h.MONTHS)),
        "future_report": ("any", dated & holds(get("lag").between(-h.MONTHS, -1))),
        "any_balance": ("any", get("has_balance")),
        "any_acct_number": ("any", get("acct_number").isNotNull()),
        "any_payment": ("any", F.get(get("payment"), F.lit(0)).isNotNull()),
        "any_suit": ("any", F.get(get("suit"), F.lit(0)).isNotNull()),
        "any_suit_status": ("any", get("suit_status").isNotNull()),
        "sum_perf_avail": total(get("perf_avail").cast("int")),
        "cnt_derog_accts": total(get("derog_pol").cast("int")),
        "cnt_overdue_accts": total(get("act_acct_pol").cast("int")),
        "cnt_dpd90_l12m_accts": total(get("dpd90_pol_l12m").cast("int")),
        "cnt_dpd60_l12m_accts": total(get("dpd60_pol_l12m").cast("int")),
        "cnt_dpd30_l6m_accts": total(get("dpd30_pol_l6m").cast("int")),
        "cnt_dpd30_l12m_accts": total(get("dpd30_pol_l12m").cast("int")),
        "sum_dpd_ins_l12m": total(get("dpd30_pol_l12m_cnt")),
        "sum_dpd_ins_l6m": total(get("dpd30_pol_l6m_cnt")),
        "sum_dpd_ins_l3m": total(get("dpd30_pol_l3m_cnt")),
        "cnt_accts": ("sum", (counted & get("acct_number").isNotNull()).cast("bigint")),
    }


# --- account table form -----------------------------------------------------


def with_defaults(accounts: DataFrame) -> DataFrame:
    """Columns that an account table may leave out."""
    for name, default in (
        ("bad_number", F.lit(False)),
        ("has_balance", F.col("balance").isNotNull()),
        ("suit_status", F.lit(None).cast("string")),
    ):
        if name not in accounts.columns:
            accounts = accounts.withColumn(name, default)
    return accounts


def score_accounts(accounts: DataFrame, as_of: AsOf, cfg: PolicyConfig) -> DataFrame:
    """Add lag, months on book, flags and counts to an account table (no shuffle)."""
    out = with_defaults(accounts)
    for stage in STAGES:
        out = out.withColumns(stage(F.col, cfg, as_of))
    return out.drop(*SCRATCH)


def combined(get: Getter, prefix: str = "") -> list[Column]:
    """The aggregates of the contributions, named with ``prefix``."""
    combine = {"sum": F.sum, "max": F.max, "any": F.bool_or}
    return [combine[how](value).alias(prefix + name) for name, (how, value) in contributions(get).items()]


def roll_up(scored: DataFrame, key: str = "request_id", also: dict[str, Column] | None = None) -> DataFrame:
    """One row per request; ``also`` names further conditions that hold if any row meets them.

    Every aggregate is a sum, max or any, so Spark combines rows before the
    shuffle and a request with very many accounts costs one row per task.
    """
    more = [F.bool_or(value).alias(name) for name, value in (also or {}).items()]
    return scored.groupBy(key).agg(*combined(F.col), *more)


# --- nested form ------------------------------------------------------------


def extend_structs(items: Column, known: list[str], stage: Stage, cfg, as_of) -> tuple[Column, list[str]]:
    """Append one stage's fields to every struct of an array."""
    names: list[str] = []

    def widen(x: Column) -> Column:
        added = stage(lambda n: x[n], cfg, as_of)
        names[:] = list(added)
        return F.struct(
            *[x[n].alias(n) for n in known], *[v.alias(n) for n, v in added.items()]
        )

    widened = F.transform(items, widen)
    return widened, known + names


def fold_structs(items: Column) -> Column:
    """Roll an account array up to one struct; null for a null array."""
    zero = {
        "sum": lambda: F.lit(0).cast("bigint"),
        "max": lambda: F.lit(None).cast("int"),
        "any": lambda: F.lit(False),
    }
    shape = {name: how for name, (how, _) in contributions(F.col).items()}

    def merge(acc: Column, x: Column) -> Column:
        merged = []
        for name, (how, value) in contributions(lambda n: x[n]).items():
            if how == "sum":
                both = acc[name] + value
            elif how == "max":
                both = F.greatest(acc[name], value)
            else:
                both = acc[name] | value
            merged.append(both.alias(name))
        return F.struct(*merged)

    start = F.struct(*[zero[how]().alias(name) for name, how in shape.items()])
    return F.aggregate(items, start, merge)
