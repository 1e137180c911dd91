"""DuckDB CTEs for the request documents: what a correct reader must find.

The documents are functions of the customer key, so the expected values are
computed from the key directly and never from JSON.
"""

from __future__ import annotations

from bridge import flat_sql as q
from bridge import shapes as sh
from bridge.shapes import DUCK
from tradeline.schemas import bureau_fields

_A, _LAG, _CLOSED = "(request_id * 5 + j)", sh.doc_lag("request_id", "a", "j"), sh.doc_closed_ago("request_id", "a", "j")


def requests(envelope: bool = True) -> str:
    """CTE ``req``, one row per document."""
    k, seg = "c_custkey", "c_mktsegment"
    return f"""req AS (
  SELECT {k} AS request_id, {k} % 97 AS v,
         CASE WHEN {k} % 97 <> 5 THEN 'U' || {k} END AS user_id,
         CASE WHEN {k} % 97 NOT IN (5, 17, 47) THEN 'R' || {k} END AS reportnumber,
         CASE WHEN {k} % 97 = 23 AND {sh.route(k)} = 'NOHIT' THEN 'HIT' ELSE {sh.route(k)} END AS route,
         CASE WHEN {k} % 97 = 59 THEN NULL ELSE coalesce({sh.score(k)}, 99999) END AS score,
         CAST({sh.doc_accounts(k, DUCK)} AS BIGINT) AS n_acct,
         CASE WHEN {k} % 10 = 9 THEN 2 ELSE 1 END AS header_rows,
         CASE WHEN {k} % 23 = 5 THEN 2 ELSE 1 END AS n_phones,
         CASE WHEN {k} % 17 = 0 THEN CAST(950 AS DOUBLE) WHEN {k} % 97 = 53 THEN NULL
              ELSE {sh.limit_score(k)} END AS limit_score,
         {sh.base_limit('c_acctbal')} AS base_limit,
         CAST(abs(round(c_acctbal * 100)) AS BIGINT) AS cents,
         {sh.min_income(k, seg)} AS min_income, {sh.max_income(k, seg)} AS max_income
  FROM customer)"""


REQ = requests()

ACCT = f"""acct0 AS (
  SELECT request_id, v, n_acct, cents, unnest(generate_series(0, n_acct - 1)) AS j FROM req),
acct1 AS (SELECT *, {_A} AS a FROM acct0),
acct2 AS (
  SELECT *, a AS acct, {_LAG} AS lag0, {_CLOSED} AS closed_ago,
         CAST({sh.doc_opened('request_id', 'a', DUCK)} AS TIMESTAMP)
           + CASE WHEN a % 6 = 3 THEN INTERVAL '10:20:30' ELSE INTERVAL '0' END AS opened
  FROM acct1),
acct AS (
  SELECT *, CAST(lag0 AS BIGINT) AS lag, {sh.months_before('lag0', DUCK)} AS reported,
         {sh.months_before('closed_ago', DUCK)} AS closed,
         CAST({q.months_to('opened')} AS BIGINT) AS mob,
         opened IS NOT NULL AND lag0 IS NOT NULL AS usable,
         CASE WHEN v = 67 OR (v = 31 AND j = n_acct - 1) THEN NULL WHEN a % 4 = 0 THEN 0
              ELSE CAST(cents + j AS DOUBLE) END AS balance,
         CASE WHEN a % 41 = 0 THEN CAST(500 AS DOUBLE) END AS writeoff,
         CASE WHEN v = 29 THEN 0 ELSE 12 + a % 38 END AS n_hist
  FROM acct2)"""

ENQ = f"""enq0 AS (
  SELECT request_id, unnest(generate_series(0, request_id % 16 - 1)) AS e FROM req WHERE request_id % 16 <> 0),
enq AS (
  SELECT request_id, e, {sh.months_before('((request_id + e) % 9)', DUCK)}
         + CAST((request_id + e) % 28 AS INTEGER) AS date FROM enq0),
enq_count AS (
  SELECT request_id, count(*) FILTER (coalesce({q.months_to('date')} <= 3, false)) AS n
  FROM enq GROUP BY request_id)"""


def judged(envelope: bool = True, limited: str | None = None) -> str:
    """CTEs ``fact`` and ``judged``: error reason, routing and decision per document."""
    wrapper = (
        "WHEN v = 11 THEN 'MISSING_ENVELOPE' WHEN v = 83 THEN 'BAD_NUMBER'" if envelope else ""
    )
    limit_error = (
        "WHEN limit_score IS NULL OR base_limit IS NULL THEN 'BAD_LIMIT_INPUT'" if envelope else ""
    )
    undated = "true" if envelope else "false"
    source = limited or q.limited("ruled") if envelope else (
        "limited AS (SELECT *, CAST(NULL AS BIGINT) AS bnpl_limit FROM ruled)"
    )
    # A document without a limit score has no band; keep its row.
    source = source.replace("FROM banded JOIN grid", "FROM banded LEFT JOIN grid")
    return f"""{source},
fact AS (
  SELECT request_id,
         bool_or(opened IS NOT NULL AND closed IS NULL AND reported IS NULL) AS null_tenure,
         bool_or(opened IS NOT NULL AND lag IS NULL) AS null_report,
         bool_or(opened IS NOT NULL AND coalesce(lag <= 48, false)) AS recent,
         bool_or(opened IS NOT NULL AND coalesce(lag BETWEEN -48 AND -1, false)) AS ahead
  FROM acct GROUP BY request_id),
checked AS (
  SELECT l.*, CASE WHEN v = 5 THEN 'BAD_JSON' {wrapper} WHEN v = 17 THEN 'MISSING_HEADER'
         WHEN v = 23 AND route <> 'INVALID' THEN 'MISSING_REPORT'
         WHEN route = 'HIT' AND (n_acct = 0 OR v = 29) THEN 'MISSING_HISTORY'
         WHEN route = 'HIT' AND v = 59 THEN 'BAD_NUMBER'
         WHEN route = 'HIT' AND v = 67 THEN 'MISSING_FIELD'
         WHEN route = 'HIT' AND v = 31 THEN 'BAD_NUMBER'
         WHEN route = 'HIT' AND null_tenure THEN 'NULL_TENURE'
         WHEN route = 'HIT' AND null_report AND recent THEN 'NULL_REPORT_DATE'
         WHEN route = 'HIT' AND ahead THEN 'FUTURE_REPORT_DATE'
         WHEN route = 'HIT' AND n_usable > 0 AND v = 71 THEN 'MISSING_FIELD'
         WHEN route = 'HIT' AND n_usable > 0 AND v = 47 THEN 'NULL_REPORT_NUMBER'
         {limit_error} END AS error_reason
  FROM limited l LEFT JOIN fact USING (request_id)),
judged AS (
  SELECT * EXCLUDE (bnpl_limit),
         CASE WHEN error_reason IS NULL THEN bnpl_limit END AS bnpl_limit,
         CASE WHEN error_reason IS NOT NULL OR route = 'INVALID' THEN NULL WHEN route = 'NOHIT' THEN 'True'
              WHEN n_usable = 0 THEN '0' WHEN {' AND '.join(q.RULES)} THEN 'True' ELSE 'False' END AS accept_ind,
         CASE WHEN error_reason IS NOT NULL THEN NULL WHEN route = 'INVALID' THEN 'NA'
              WHEN route = 'NOHIT' THEN 'NTC'
              WHEN n_acct * greatest(header_rows, n_phones) <= 1 AND coalesce(max_mob < 6, {undated}) THEN 'NTC'
              ELSE 'ETC' END AS bureau_history_status
  FROM checked)"""


# Everything up to the decision, for documents with the envelope.
DECIDED = [REQ, ACCT, q.CELL, q.FLAG, ENQ, q.METRIC, q.GRID, judged()]


# --- the 271-column account table -------------------------------------------


def _pivot() -> str:
    series = (("suitst", "s"), ("acctst", "p"), ("assetst", "a"))
    columns = ", ".join(
        f"max({level}) FILTER (k = {i}) AS {name}_l{i}m" for name, level in series for i in range(49)
    )
    return f"piv AS (SELECT acct, {columns} FROM level WHERE lag <= 48 AND k <= 47 GROUP BY acct)"


def bureau_table() -> str:
    """SELECT for the account table of all processable documents."""
    cell_49 = lambda formula: f"CASE WHEN n_hist > 48 THEN {formula} END"
    ten = "(year({0}) * 12 + month({0}) - (year(opened) * 12 - month(opened)))"
    text = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    k, a = "request_id", "a"
    status = f"CASE WHEN {k} % 4 = 0 AND {a} % 2 = 0 THEN 'NS' END"
    high = f"CASE WHEN {k} % 6 >= 3 AND {a} % 4 <> 0 THEN '1' || {a} END"
    sanction = f"CASE WHEN {k} % 6 NOT IN (0, 3) THEN '2' || {a} END"
    account = {
        "seq": "CAST(j + 1 AS VARCHAR)", "acct_number": f"'A' || {a}",
        "institution": f"'I' || {a} % 7", "accounttype": f"'T' || {a} % 5",
        "ownershiptype": "'Individual'", "balance": "balance", "pastdueamount": f"CAST({a} % 3 AS VARCHAR)",
        "open": f"CASE WHEN {a} % 3 = 0 THEN 'No' ELSE 'Yes' END",
        "highcredit": f"CASE WHEN any_high THEN coalesce({high}, {sanction}) ELSE '3' || {a} END",
        "creditlimit": f"'3' || {a}", "sanctionamount": sanction, "writeoffamount": "writeoff",
        "suitfiledstatus": f"CASE WHEN any_status THEN {status} ELSE {sh.suit(a, '0')} END",
        "days_past_due": "dpd", "acct_uniq_id": "CAST(j AS INTEGER)",
        "acct_st_49": cell_49(sh.payment(k, a, "48")), "suit_filed_st_49": cell_49(sh.suit(a, "48")),
        "asset_cl_st_49": cell_49(sh.asset(a, "48")),
        "dateopened_n": text("opened"), "dateclosed_n": text("closed"), "datereported_n": text("reported"),
        "acct_mob": "CAST(mob AS INTEGER)", "score": "score",
        "tenure_clo_ope": f"CAST({ten.format('closed')} AS INTEGER)",
        "tenure_rep_ope": f"CAST({ten.format('reported')} AS INTEGER)",
        "tenure_avai": f"CAST(coalesce({ten.format('closed')}, {ten.format('reported')}) AS INTEGER)",
        "non_avail_per": "CAST(lag AS INTEGER)",
        "sco_pol": "score >= 700", "inq_flag": "max_inq_l3m",
        "collateraltype": f"CASE WHEN {a} % 8 = 0 THEN 'Gold' END",
    }
    for name, value in (
        ("purpose", "'ALL'"), ("total", f"CAST({k} % 16 AS VARCHAR)"), ("past30days", f"CAST({k} % 2 AS VARCHAR)"),
        ("past12months", f"CAST({k} % 12 AS VARCHAR)"), ("past24months", f"CAST({k} % 16 AS VARCHAR)"),
        ("recent", f"'r' || {k} % 3"),
    ):
        account[name] = f"CASE WHEN {k} % 19 <> 0 THEN {value} END"
    for flag in ("perf_avail", "derog_pol", "act_acct_pol", "dpd90_pol_l12m", "dpd60_pol_l12m",
                 "dpd30_pol_l6m", "dpd30_pol_l12m"):
        account[flag] = flag
    for m in (12, 6, 3):
        account[f"dpd30_pol_l{m}m_cnt"] = f"CAST(dpd30_pol_l{m}m_cnt AS INTEGER)"
    for i in range(49):
        account[f"key_{i}"] = f"CASE WHEN n_hist > {i} THEN 'm{i}' END"
        for series in ("suitst", "acctst", "assetst"):
            account[f"{series}_l{i}m"] = f"{series}_l{i}m"
    header = {
        "client_id": f"CASE WHEN head < header_rows THEN 'C' || {k} END",
        "reference_no": f"CASE WHEN head < header_rows THEN 'ref' || {k} % 10 END",
        "user_id": "user_id",
        "reportnumber": "CASE WHEN head < header_rows THEN reportnumber END",
        "productcode": "CASE WHEN head < header_rows THEN CASE head WHEN 0 THEN 'PCS' ELSE 'IDCR' END END",
        "successcode": "CASE WHEN head < header_rows THEN '1' END",
        "date": "CASE WHEN head < header_rows THEN '2024-01-31' END",
        "time": "CASE WHEN head < header_rows THEN '09:08:07' END",
        "inquirypurpose": "CASE WHEN head < n_phones THEN 'PL' END",
        "firstname": f"CASE WHEN head < n_phones THEN 'N' || {k} END",
        "lastname": f"CASE WHEN head < n_phones AND {k} % 2 = 0 THEN 'L' END",
        "phonetype": "CASE WHEN head < n_phones THEN CASE WHEN head = 1 THEN 'H' WHEN n_phones = 2 THEN 'M' ELSE 'W' END END",
        "number": f"CASE WHEN head < n_phones THEN CASE head WHEN 0 THEN '5' || {k} ELSE '6' || {k} END END",
        "input_detail_type": "CASE WHEN route = 'INVALID' THEN 'Invalid_Detail' ELSE 'Valid_Detail' END",
        "errorcode": f"CASE WHEN route <> 'HIT' AND head = 0 THEN 'E' || {k} % 7 END",
        "errordesc": "CASE WHEN route <> 'HIT' AND head = 0 THEN 'not found' END",
        "bur_hist_sta": "CASE route WHEN 'HIT' THEN 'ETC' WHEN 'NOHIT' THEN 'NTC' END",
    }
    cast = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
            "timestamp_ntz": "VARCHAR"}  # dates are compared as text

    def columns(with_account: bool) -> str:
        out = []
        for name, kind in bureau_fields():
            value = header.get(name) or (account.get(name, "NULL") if with_account else "NULL")
            out.append(f"CAST({value} AS {cast[kind]}) AS {name}")
        return ", ".join(out)

    return f"""SELECT CAST(request_id AS VARCHAR) AS request_id, {columns(True)}
FROM (SELECT jd.*, f.*  EXCLUDE (request_id, v, n_acct), piv.* EXCLUDE (acct), CAST(0 AS BIGINT) AS head,
      bool_or({high.replace('request_id', 'f.request_id').replace(' a ', ' f.a ').replace('|| a', '|| f.a')} IS NOT NULL
        OR f.request_id % 6 NOT IN (0, 3)) OVER w AS any_high,
      bool_or(f.request_id % 4 = 0 AND f.a % 2 = 0) OVER w AS any_status
      FROM judged jd JOIN flag f USING (request_id) LEFT JOIN piv ON piv.acct = f.acct
      WHERE error_reason IS NULL AND route = 'HIT' WINDOW w AS (PARTITION BY f.request_id))
WHERE usable
UNION ALL
SELECT CAST(request_id AS VARCHAR), {columns(False)}
FROM (SELECT *, unnest(generate_series(0, greatest(header_rows, n_phones) - 1)) AS head FROM judged
      WHERE error_reason IS NULL AND route <> 'HIT')"""


PIVOT = _pivot()
