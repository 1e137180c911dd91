"""Account metrics kept up to date: what changes in which month.

Every metric of the policy is a sum over accounts, and what one account adds to it changes in a few known
months only: a late month counts from the month after it for three, six or twelve months, a history is visible
for 48 months, a severe code for 47 after its own, an account is young until its 48th month. So an account is written
as rows (metric, month, change), and a metric as of any month is the sum of the changes up to it.

Such rows are summed by request, metric and month, before and after any shuffle. A new delivery adds its own
rows and scores no old account; a later decision date adds up further. Dates before an account's last report are out of
reach (the plan over accounts treats those as reported in the future).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions import history as h
from tradeline.functions.codes import code_level
from tradeline.functions.dates import AsOf, month_index, month_number
from tradeline.operators import accounts as acc
from tradeline.plans import ledger

#: The month of changes that hold from the beginning.
START = 0
_TYPE = "array<struct<metric: string, month: int, change: bigint>>"
#: Late months further back than this are in no look-back window of the reporting month or later.
_LATE_MONTHS = 13

SUMS = (
    "n_accounts", "n_dated", "n_usable", "sum_perf_avail", "cnt_derog_accts", "cnt_overdue_accts",
    "cnt_dpd90_l12m_accts", "cnt_dpd60_l12m_accts", "cnt_dpd30_l6m_accts", "cnt_dpd30_l12m_accts",
    "sum_dpd_ins_l12m", "sum_dpd_ins_l6m", "sum_dpd_ins_l3m", "cnt_accts", "inq_flag",
)
FLAGS = (
    "bad_number", "null_tenure", "null_report_date", "recent_report", "future_report", "any_balance",
    "any_acct_number", "any_payment", "any_suit", "any_suit_status",
)


def _change(metric: str, month: Column, change: int) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"), month.cast("int").alias("month"), F.lit(change).cast("bigint").alias("change")
    )


def _when(condition: Column, *changes: Column) -> Column:
    return F.when(acc.holds(condition), F.array(*changes)).otherwise(F.array().cast(_TYPE))


def _from_start(metric: str, last: Column | None = None) -> list[Column]:
    """Counts from the beginning, up to the month ``last`` if one is given."""
    ends = [] if last is None else [_change(metric, last + 1, -1)]
    return [_change(metric, F.lit(START), 1), *ends]


def _places(codes: Column, table: dict[str, int], level: int, months: int) -> Column:
    """Rising positions of codes of at least this severity among the first ``months``."""
    severe = [code for code, value in table.items() if value >= level]
    marked = F.transform(F.slice(codes, 1, months), lambda code, i: F.when(code.isin(severe), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _instances(metric: str, late: Column, reported: Column, window: int) -> Column:
    """Each late month counts in the ``window`` months after it."""
    return F.flatten(
        F.transform(
            late,
            lambda i: F.array(_change(metric, reported - i + 1, 1), _change(metric, reported - i + window + 1, -1)),
        )
    )


def _any_instance(metric: str, late: Column, reported: Column, window: int) -> Column:
    """One count while any late month lies in the window: overlapping windows make one."""
    older = F.slice(late, 2, F.array_size(late))
    younger = F.concat(F.array(F.lit(None).cast("int")), late)
    first = F.zip_with(late, older, lambda i, n: F.when(n.isNull() | (n - i > window), i))
    last = F.zip_with(late, younger, lambda i, n: F.when(n.isNull() | (i - n > window), i))
    known = lambda places: F.filter(places, lambda i: i.isNotNull())
    return F.concat(
        F.transform(known(first), lambda i: _change(metric, reported - i + 1, 1)),
        F.transform(known(last), lambda i: _change(metric, reported - i + window + 1, -1)),
    )


def _account_changes(get: acc.Getter, cfg: PolicyConfig) -> Column:
    """All changes of one account."""
    opened, reported = month_index(get("opened")), month_index(get("reported"))
    dated, counted = acc.opened_known(get), acc.opened_known(get) & get("reported").isNotNull()
    payment = get("payment")

    def severe(series: str, table: dict[str, int], level: int) -> Column:
        return reported + h.MONTHS - 1 - F.array_min(_places(get(series), table, level, h.MONTHS))

    derog_until = F.greatest(
        F.when(get("writeoff") > 0, opened + cfg.derog_max_mob),
        severe("payment", cfg.payment_codes, cfg.derog_payment),
        severe("asset", cfg.asset_codes, cfg.derog_asset),
        severe("suit", cfg.suit_codes, cfg.derog_suit),
    )
    overdue = (get("balance") > 0) & (code_level(F.get(payment, F.lit(0)), cfg.payment_codes) > 0)
    late = lambda level: _places(payment, cfg.payment_codes, level, _LATE_MONTHS)
    visible_until = reported + h.MONTHS
    empty = F.array().cast(_TYPE)
    parts = [
        F.array(*_from_start("n_accounts")),
        _when(dated, *_from_start("n_dated"), _change("opened", opened, 1)),
        _when(counted, *_from_start("n_usable"), *_from_start("sum_perf_avail", visible_until)),
        _when(counted & get("acct_number").isNotNull(), *_from_start("cnt_accts")),
        _when(counted & overdue, *_from_start("cnt_overdue_accts")),
        _when(counted & derog_until.isNotNull(), *_from_start("cnt_derog_accts", derog_until)),
        _when(get("bad_number"), *_from_start("bad_number")),
        _when(dated & get("closed").isNull() & get("reported").isNull(), *_from_start("null_tenure")),
        _when(dated & get("reported").isNull(), *_from_start("null_report_date")),
        _when(counted, *_from_start("recent_report", visible_until)),
        _when(counted, _change("future_report", reported - h.MONTHS, 1), _change("future_report", reported, -1)),
        _when(get("has_balance"), *_from_start("any_balance")),
        _when(get("acct_number").isNotNull(), *_from_start("any_acct_number")),
        _when(F.get(payment, F.lit(0)).isNotNull(), *_from_start("any_payment")),
        _when(F.get(get("suit"), F.lit(0)).isNotNull(), *_from_start("any_suit")),
        _when(get("suit_status").isNotNull(), *_from_start("any_suit_status")),
    ]
    windows = [(f"sum_dpd_ins_l{n}m", cfg.dpd30, n, _instances) for n in (12, 6, 3)] + [
        ("cnt_dpd90_l12m_accts", cfg.dpd90, 12, _any_instance),
        ("cnt_dpd60_l12m_accts", cfg.dpd60, 12, _any_instance),
        ("cnt_dpd30_l12m_accts", cfg.dpd30, 12, _any_instance),
        ("cnt_dpd30_l6m_accts", cfg.dpd30, 6, _any_instance),
    ]
    parts += [
        F.when(acc.holds(counted), F.coalesce(make(metric, late(level), reported, months), empty)).otherwise(empty)
        for metric, level, months, make in windows
    ]
    return F.flatten(F.array(*parts))


def _summed(rows: DataFrame) -> DataFrame:
    """Changes added up; those that cancel out go."""
    total = rows.groupBy("request_id", "metric", "month").agg(F.sum("change").alias("change"))
    return total.where(F.col("change") != 0)


def account_changes(accounts: DataFrame, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """request_id, metric, month, change of an account table (one delivery of it)."""
    rows = acc.with_defaults(accounts).select("request_id", F.explode(_account_changes(F.col, cfg)).alias("c"))
    return _summed(rows.select("request_id", "c.*"))


def enquiry_changes(enquiries: DataFrame, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """The same of an enquiry table: an enquiry is recent until ``enquiry_months`` after its month."""
    last = month_index(F.col("date")) + cfg.enquiry_months
    rows = enquiries.where(F.col("date").isNotNull())
    rows = rows.select("request_id", F.explode(F.array(*_from_start("inq_flag", last))).alias("c"))
    return _summed(rows.select("request_id", "c.*"))


def save_delivery(changes: DataFrame, path: str, delivery: str) -> None:
    """Write the changes of one delivery. A delivery that is repeated under its name replaces itself."""
    changes.write.mode("overwrite").parquet(f"{path}/delivery={delivery}")


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    """The changes of all deliveries, added up."""
    return _summed(spark.read.parquet(path))


def facts_at(changes: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per request with the metrics as of a month: the columns of the account roll-up and ``inq_flag``.

    With a date column, ``changes`` has it (see ``ledger.with_dates``).
    """
    now = month_number(as_of)

    def total(metric: str) -> Column:
        counted = (F.col("metric") == metric) & (F.col("month") <= now)
        return F.coalesce(F.sum(F.when(counted, F.col("change"))), F.lit(0).cast("bigint"))

    oldest = F.max(F.when(F.col("metric") == "opened", now - F.col("month")))
    return changes.groupBy("request_id").agg(
        *[total(name).alias(name) for name in SUMS],
        *[(total(name) > 0).alias(name) for name in FLAGS],
        oldest.cast("int").alias("max_mob"),
    )


def decide_changes(requests: DataFrame, changes: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Decision table of ``requests`` as of a date, from changes alone."""
    joined = requests.join(facts_at(changes, as_of), "request_id", "left")
    rows = ledger.decided(ledger.ruled(joined, cfg), as_of, cfg)
    return rows.select(*[n for n, _ in s.DECISION_FIELDS])
