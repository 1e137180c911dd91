"""DuckDB CTEs over the flat tables: requests, accounts, month cells, metrics.

Histories are exploded to one row per month here, while the Spark side works on
arrays, so the two sides share the data but not the method.
"""

from __future__ import annotations

from bridge import shapes as sh
from bridge.shapes import AS_OF_MONTH, DUCK
from bridge.expected import (
    ASSET_CODES, INCOME_BRACKETS, LIMIT_CEILING, LIMIT_FLOOR, LIMIT_MULTIPLIER, PAYMENT_CODES,
    SCORE_BANDS, SUIT_CODES,
)


def months_to(date: str) -> str:
    return f"({AS_OF_MONTH} - (year({date}) * 12 + month({date})))"


def decided_later(sql: str, months: str) -> str:
    """``sql`` with a decision date that lies ``months`` after the usual one; may be an expression of the request."""
    return sql.replace(f"({AS_OF_MONTH} -", f"({AS_OF_MONTH} + {months} -").replace(
        "CAST(lag0 AS BIGINT) AS lag", f"CAST(lag0 + {months} AS BIGINT) AS lag"
    )


_K, _A = "o_custkey", "o_orderkey"

REQ = f"""req AS (
  SELECT c_custkey AS request_id, 'R' || c_custkey AS reportnumber,
         {sh.route('c_custkey')} AS route, {sh.score('c_custkey')} AS score,
         {sh.limit_score('c_custkey')} AS limit_score, {sh.base_limit('c_acctbal')} AS base_limit,
         {sh.min_income('c_custkey', 'c_mktsegment')} AS min_income,
         {sh.max_income('c_custkey', 'c_mktsegment')} AS max_income
  FROM customer)"""

ACCT = f"""acct0 AS (
  SELECT {_K} AS request_id, {_A} AS acct,
         {sh.opened(_K, _A, 'o_orderdate', DUCK)} AS opened,
         {sh.months_before(f'({_A} % 53)', DUCK)} AS reported,
         CASE WHEN o_orderstatus = 'F' THEN {sh.months_before(f'({_A} % 53)', DUCK)} END AS closed,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS balance,
         CASE WHEN {_A} % 97 = 0 THEN o_totalprice END AS writeoff,
         CASE WHEN {_K} % 6 >= 3 AND {_A} % 4 <> 0 THEN o_totalprice + 1 END AS highcredit,
         CASE WHEN {_K} % 6 NOT IN (0, 3) THEN o_totalprice + 2 END AS sanctionamount,
         o_totalprice AS creditlimit,
         CASE WHEN {_K} % 4 = 0 AND {_A} % 2 = 0 THEN 'NS' END AS suit_status,
         CAST(12 + {_A} % 37 AS BIGINT) AS n_hist
  FROM orders),
acct AS (
  SELECT *, CAST({months_to('reported')} AS BIGINT) AS lag, CAST({months_to('opened')} AS BIGINT) AS mob,
         opened IS NOT NULL AS usable
  FROM acct0)"""

CELL = f"""cell0 AS (
  SELECT request_id, acct, lag, n_hist, unnest(generate_series(0, n_hist - 1)) AS i FROM acct),
cell AS (
  SELECT request_id, acct, lag, i, i + greatest(lag, 0) AS k,
         {sh.payment('request_id', 'acct', 'i')} AS payment,
         {sh.suit('acct', 'i')} AS suit, {sh.asset('acct', 'i')} AS asset
  FROM cell0),
level AS (
  SELECT request_id, acct, lag, i, k, payment, suit, asset,
         {sh.coded('payment', PAYMENT_CODES)} AS p, {sh.coded('suit', SUIT_CODES)} AS s,
         {sh.coded('asset', ASSET_CODES)} AS a
  FROM cell)"""

# One row per account: flags and counts from the exploded months.
FLAG = """seen AS (
  SELECT acct, max(p) AS worst_p, max(s) AS worst_s, max(a) AS worst_a,
         max(p) FILTER (k BETWEEN 1 AND 12) AS worst_12, max(p) FILTER (k BETWEEN 1 AND 6) AS worst_6,
         count(*) FILTER (k BETWEEN 1 AND 12 AND p >= 2) AS n12,
         count(*) FILTER (k BETWEEN 1 AND 6 AND p >= 2) AS n6,
         count(*) FILTER (k BETWEEN 1 AND 3 AND p >= 2) AS n3
  FROM level WHERE lag <= 48 AND k <= 47 GROUP BY acct),
first_month AS (SELECT acct, p AS dpd FROM level WHERE i = 0),
flag AS (
  SELECT a.*, f.dpd, a.lag <= 48 AS perf_avail,
         coalesce(a.mob <= 48 AND a.writeoff > 0, false) OR coalesce(worst_p >= 5, false)
           OR coalesce(worst_a >= 4, false) OR coalesce(worst_s >= 0, false) AS derog_pol,
         coalesce(a.balance > 0 AND f.dpd > 0, false) AS act_acct_pol,
         coalesce(worst_12 >= 4, false) AS dpd90_pol_l12m, coalesce(worst_12 >= 3, false) AS dpd60_pol_l12m,
         coalesce(worst_6 >= 2, false) AS dpd30_pol_l6m, coalesce(worst_12 >= 2, false) AS dpd30_pol_l12m,
         coalesce(n12, 0) AS dpd30_pol_l12m_cnt, coalesce(n6, 0) AS dpd30_pol_l6m_cnt,
         coalesce(n3, 0) AS dpd30_pol_l3m_cnt
  FROM acct a LEFT JOIN seen USING (acct) LEFT JOIN first_month f USING (acct))"""

ENQ = f"""enq AS (
  SELECT event_id, user_id AS request_id,
         CASE WHEN event_id % 101 <> 0 THEN {sh.months_before('(event_id % 40)', DUCK)} END AS date
  FROM events),
enq_count AS (
  SELECT request_id, count(*) FILTER (coalesce({months_to('date')} <= 3, false)) AS n
  FROM enq GROUP BY request_id)"""

METRIC = """rolled AS (
  SELECT request_id, count(*) AS n_accounts, max(mob) AS max_mob,
         count(*) FILTER (usable) AS n_usable,
         count(*) FILTER (usable AND perf_avail) AS sum_perf_avail,
         count(*) FILTER (usable AND derog_pol) AS cnt_derog_accts,
         count(*) FILTER (usable AND act_acct_pol) AS cnt_overdue_accts,
         count(*) FILTER (usable AND dpd90_pol_l12m) AS cnt_dpd90_l12m_accts,
         count(*) FILTER (usable AND dpd60_pol_l12m) AS cnt_dpd60_l12m_accts,
         count(*) FILTER (usable AND dpd30_pol_l6m) AS cnt_dpd30_l6m_accts,
         count(*) FILTER (usable AND dpd30_pol_l12m) AS cnt_dpd30_l12m_accts,
         CAST(coalesce(sum(dpd30_pol_l12m_cnt) FILTER (usable), 0) AS BIGINT) AS sum_dpd_ins_l12m,
         CAST(coalesce(sum(dpd30_pol_l6m_cnt) FILTER (usable), 0) AS BIGINT) AS sum_dpd_ins_l6m,
         CAST(coalesce(sum(dpd30_pol_l3m_cnt) FILTER (usable), 0) AS BIGINT) AS sum_dpd_ins_l3m,
         count(acct) FILTER (usable) AS cnt_accts
  FROM flag GROUP BY request_id),
metric AS (
  SELECT q.*, r.* EXCLUDE (request_id), coalesce(e.n, 0) AS max_inq_l3m,
         coalesce(q.score, 99999) >= 700 AS max_score
  FROM req q LEFT JOIN rolled r USING (request_id) LEFT JOIN enq_count e USING (request_id)),
ruled AS (
  SELECT *, coalesce(sum_perf_avail > 0, false) AS sum_perf_avail_dec,
         coalesce(cnt_derog_accts = 0, false) AS cnt_derog_accts_dec,
         coalesce(cnt_overdue_accts <= 1, false) AS cnt_overdue_accts_dec,
         coalesce(cnt_dpd90_l12m_accts <= 0, false) AS cnt_dpd90_l12m_accts_dec,
         coalesce(cnt_dpd60_l12m_accts <= 1, false) AS cnt_dpd60_l12m_accts_dec,
         coalesce(cnt_dpd30_l6m_accts <= 1, false) AS cnt_dpd30_l6m_accts_dec,
         coalesce(CAST(cnt_dpd30_l12m_accts AS DOUBLE) / nullif(cnt_accts, 0) <= CAST(0.33 AS DOUBLE), false)
           AS cnt_dpd30_l12m_accts_rt_dec,
         coalesce(sum_dpd_ins_l12m <= 5, false) AS sum_dpd_ins_l12m_dec,
         coalesce(sum_dpd_ins_l6m <= 3, false) AS sum_dpd_ins_l6m_dec,
         coalesce(sum_dpd_ins_l3m <= 0, false) AS sum_dpd_ins_l3m_dec,
         NOT (max_inq_l3m > 10) AS max_inq_l3m_dec, max_score AS max_score_dec
  FROM metric)"""

RULES = (
    "sum_perf_avail_dec", "cnt_derog_accts_dec", "cnt_overdue_accts_dec", "cnt_dpd90_l12m_accts_dec",
    "cnt_dpd60_l12m_accts_dec", "cnt_dpd30_l6m_accts_dec", "cnt_dpd30_l12m_accts_rt_dec",
    "sum_dpd_ins_l12m_dec", "sum_dpd_ins_l6m_dec", "sum_dpd_ins_l3m_dec", "max_inq_l3m_dec",
    "max_score_dec",
)


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def score_band(score: str, bands=SCORE_BANDS, lowest: str = "G") -> str:
    arms = " ".join(f"WHEN {score} >= {bound} THEN '{band}'" for band, bound in bands)
    return f"CASE {arms} ELSE '{lowest}' END"


def income_band(low: str, high: str, brackets=INCOME_BRACKETS) -> str:
    arms = " ".join(
        f"WHEN {low} = {lo} AND {f'{high} IS NULL' if hi is None else f'{high} = {hi}'} THEN {band}"
        for lo, hi, band in brackets
    )
    return f"CASE {arms} ELSE 1 END"


def grid(multiplier: dict, ceiling: dict, floor: dict) -> str:
    """CTE ``grid``: one row for each cell of the three tables."""
    cells = ", ".join(
        f"('{band}', {i + 1}, CAST({row[i]} AS DOUBLE), CAST({ceiling[band][i]} AS DOUBLE), CAST({floor[band][i]} AS DOUBLE))"
        for band, row in multiplier.items()
        for i in range(len(row))
    )
    return f"grid(score_band, income_band, multiplier, max_cap, min_cap) AS (VALUES {cells})"


GRID = grid(LIMIT_MULTIPLIER, LIMIT_CEILING, LIMIT_FLOOR)


def limited(
    source: str,
    score: str = score_band("limit_score"),
    income: str = income_band("min_income", "max_income"),
    step: int = 100,
) -> str:
    """CTE ``limited``: the rows of ``source`` with bands, grid values and limit."""
    return f"""banded AS (
  SELECT *, {score} AS score_band, {income} AS income_band
  FROM {source}),
limited AS (
  SELECT *, CAST(ceil(greatest(least(base_limit * multiplier, max_cap), min_cap) / {step}) * {step} AS BIGINT) AS bnpl_limit
  FROM banded JOIN grid USING (score_band, income_band))"""
