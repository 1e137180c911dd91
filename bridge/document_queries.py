"""Registered queries over request documents (JSON built from the customer table)."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Window
from pyspark.sql import functions as F

from bridge import document_sql as d
from bridge import flat_queries as fq
from bridge import flat_sql as q
from bridge import tables as t
from bridge.registry import query
from bridge.shapes import AS_OF
from tradeline import config as cfgs
from tradeline import schemas as s
from tradeline.functions.dates import parse_date
from tradeline.operators import flatten, parse, policy
from tradeline.plans import documents, export, ledger
from tradeline.plans.jobs import run_batch
from tradeline.session import new_path
from tradeline.sources import requests as src
from tradeline.sources import sinks
from tradeline.streaming.decisions import run_stream

CFG = cfgs.CURRENT


def parsed(spark, sf, parts=s.REPORT_PARTS):
    return parse.parse_requests(t.documents(spark, sf), parts=parts)


def scored(spark, sf):
    return documents.score_requests(parsed(spark, sf), AS_OF)


def exploded(spark, sf, *columns):
    """One row per raw account with the given request columns."""
    return flatten.accounts(parsed(spark, sf), *columns)


ID = "CAST(request_id AS VARCHAR) AS request_id"
# Documents whose report can be read.
REPORT = "v NOT IN (5, 23) AND NOT (request_id % 50 = 1)"


# --- sources ----------------------------------------------------------------

_PARSE_SQL = q.with_ctes(
    d.REQ,
    body=f"""SELECT user_id, v = 5 AS bad_json, reportnumber,
  CASE WHEN v NOT IN (5, 11) THEN CAST(min_income AS DOUBLE) END AS min_income,
  CASE WHEN v NOT IN (5, 11) THEN CAST(max_income AS DOUBLE) END AS max_income,
  CASE WHEN v <> 5 AND request_id % 50 = 0 THEN 'E' || request_id % 7 END AS input_error,
  CASE WHEN v NOT IN (5, 23) AND request_id % 50 = 1 THEN 'E' || request_id % 7 END AS report_error,
  CASE WHEN {REPORT} THEN CAST(n_acct AS INTEGER) END AS n_accounts,
  CASE WHEN {REPORT} AND request_id % 16 <> 0 THEN CAST(request_id % 16 AS INTEGER) END AS n_enquiries FROM req""",
)


def _summary(df, *extra):
    return df.select(
        "user_id", "bad_json",
        parse.report_number().alias("reportnumber"),
        F.col("min_income").try_cast("double").alias("min_income"),
        F.col("max_income").try_cast("double").alias("max_income"),
        F.col("top_error.ErrorCode").alias("input_error"),
        F.col("report_error.ErrorCode").alias("report_error"),
        F.array_size("raw_accounts").alias("n_accounts"),
        F.array_size("raw_enquiries").alias("n_enquiries"),
        *extra,
    )


@query("src_request_parse", _PARSE_SQL)
def src_request_parse(spark, sf):
    """Write the documents as JSON lines, read them back, parse them."""
    path = new_path(spark, "requests")
    t.documents(spark, sf).select("value").write.text(path)
    return _summary(parse.parse_requests(src.read_requests(spark, path)))


@query(
    "src_request_file",
    _PARSE_SQL.replace("FROM customer", "FROM (SELECT s_suppkey AS c_custkey, s_acctbal AS c_acctbal, "
                       "'BUILDING' AS c_mktsegment FROM supplier)").replace(
        "AS n_enquiries FROM req",
        "AS n_enquiries, 'half=' || request_id % 2 || '/request_id=' || request_id AS folder, "
        "CAST(1 AS BIGINT) AS n_of_this_id FROM req"),
)
def src_request_file(spark, sf):
    """One file per request (per supplier), in two folders; its path below the root is its name."""
    path = new_path(spark, "request-files")
    docs = t.documents(spark, sf, "supplier").withColumn("half", F.expr("CAST(request_id AS INT) % 2"))
    # The documents of an id are made by one task. Each task moves its own files, not the driver all of them.
    writer = docs.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.partitionBy("half", "request_id").text(path)
    df = parse.parse_requests(src.read_request_files(spark, path))
    rows = _summary(df, "request_id", F.regexp_replace("file_name", "/[^/]*$", "").alias("folder"))
    # Only the summaries are shuffled, and every file is opened once.
    rows = rows.withColumn("n_of_this_id", F.count("*").over(Window.partitionBy("request_id")))
    return rows.drop("request_id")


# --- projections ------------------------------------------------------------

_HEAD = "v NOT IN (5, 17)"


def _header(name):
    return parse.header_at(name, F.lit(0))


@query(
    "parse_header",
    q.with_ctes(
        d.REQ,
        body=f"""SELECT {ID}, CASE WHEN {_HEAD} THEN 'C' || request_id END AS client_id,
  CASE WHEN {_HEAD} THEN 'ref' || request_id % 10 END AS reference_no, reportnumber,
  CASE WHEN {_HEAD} THEN 'PCS' END AS productcode, CASE WHEN {_HEAD} THEN '1' END AS successcode,
  CASE WHEN {_HEAD} THEN '2024-01-31' END AS date, CASE WHEN {_HEAD} THEN '09:08:07' END AS time,
  CASE WHEN v <> 5 THEN 'PL' END AS inquirypurpose, CASE WHEN v <> 5 THEN 'N' || request_id END AS firstname FROM req""",
    ),
)
def parse_header(spark, sf):
    return parsed(spark, sf, parts=()).select(
        "request_id", _header("ClientID").alias("client_id"), _header("CustRefField").alias("reference_no"),
        _header("ReportOrderNO").alias("reportnumber"), _header("ProductCode").alias("productcode"),
        _header("SuccessCode").alias("successcode"), _header("Date").alias("date"), _header("Time").alias("time"),
        F.col("inquiry.InquiryPurpose").alias("inquirypurpose"), F.col("inquiry.FirstName").alias("firstname"),
    )


_PHONES = """ph AS (SELECT request_id, n_phones, unnest(generate_series(0, n_phones - 1)) AS i FROM req WHERE v <> 5)"""


@query(
    "parse_phone",
    q.with_ctes(
        d.REQ, _PHONES,
        body=f"SELECT {ID}, CAST(i AS INTEGER) AS i, CASE WHEN i = 1 THEN 'H' WHEN n_phones = 2 THEN 'M' ELSE 'W' END AS phonetype, "
        "CASE i WHEN 0 THEN '5' || request_id ELSE '6' || request_id END AS number FROM ph",
    ),
)
def parse_phone(spark, sf):
    return flatten.phones(parsed(spark, sf, parts=()))


@query(
    "explode_accounts",
    q.with_ctes(
        d.REQ, d.ACCT,
        body=f"""SELECT {ID}, CAST(j AS INTEGER) AS ordinal, CASE WHEN v <> 71 THEN 'A' || a END AS accountnumber,
  'I' || a % 7 AS institution, CASE WHEN v = 67 THEN NULL WHEN v = 31 AND j = n_acct - 1 THEN 'abc' WHEN a % 4 = 0 THEN '0'
  ELSE CAST(cents + j AS VARCHAR) END AS balance, CAST(CASE WHEN v <> 29 THEN n_hist END AS INTEGER) AS n_months
FROM acct WHERE {REPORT}""",
    ),
)
def explode_accounts(spark, sf):
    return exploded(spark, sf).select(
        "request_id", "ordinal", F.col("a.AccountNumber").alias("accountnumber"),
        F.col("a.Institution").alias("institution"), F.col("a.Balance").alias("balance"),
        F.array_size("a.History48Months").alias("n_months"),
    )


@query(
    "account_ordinal",
    q.with_ctes(d.REQ, d.ACCT, body=f"SELECT {ID}, CAST(j AS INTEGER) AS acct_uniq_id, strftime(opened, '%Y-%m-%d') AS opened FROM acct WHERE {REPORT} AND opened IS NOT NULL"),
)
def account_ordinal(spark, sf):
    """The ordinal is taken before undated accounts are dropped."""
    opened = parse_date(F.col("a.DateOpened"), AS_OF, day_first=True)
    rows = exploded(spark, sf).select(
        "request_id", F.col("ordinal").alias("acct_uniq_id"), opened.alias("opened")
    )
    return rows.where(F.col("opened").isNotNull()).withColumn(
        "opened", F.date_format("opened", "yyyy-MM-dd")
    )


_CELLS = [d.REQ, d.ACCT, q.CELL]


@query(
    "explode_history",
    q.with_ctes(
        *_CELLS,
        body="SELECT CAST(c.request_id AS VARCHAR) AS request_id, CAST(a.j AS INTEGER) AS ordinal, CAST(i AS INTEGER) AS i, 'm' || i AS key, "
        f"payment, suit, asset FROM cell c JOIN acct a USING (acct) JOIN req r ON r.request_id = c.request_id "
        f"WHERE {REPORT.replace('request_id', 'c.request_id').replace('v NOT', 'r.v NOT')}",
    ),
)
def explode_history(spark, sf):
    return flatten.months(exploded(spark, sf)).select(
        "request_id", "ordinal", "i", F.col("h.key").alias("key"), F.col("h.PaymentStatus").alias("payment"),
        F.col("h.SuitFiledStatus").alias("suit"), F.col("h.AssetClassificationStatus").alias("asset"),
    )


_WIDE = (("acct_st", "payment"), ("suit_filed_st", "suit"), ("asset_cl_st", "asset"))


@query(
    "history_wide",
    q.with_ctes(
        *_CELLS,
        "wide AS (SELECT acct, "
        + ", ".join(f"max({c}) FILTER (i = {i}) AS {n}_{i + 1}" for n, c in _WIDE for i in range(49))
        + " FROM cell GROUP BY acct)",
        body=f"SELECT {ID}, CAST(j AS INTEGER) AS ordinal, wide.* EXCLUDE (acct) FROM acct LEFT JOIN wide USING (acct) WHERE {REPORT}",
    ),
)
def history_wide(spark, sf):
    return exploded(spark, sf).select(
        "request_id", "ordinal",
        *flatten.wide_history(F.col("a")),
    )


@query(
    "repeat_header",
    q.with_ctes(
        d.REQ, d.ACCT,
        body=f"SELECT CAST(a.request_id AS VARCHAR) AS request_id, CAST(j AS INTEGER) AS ordinal, r.user_id, r.reportnumber, "
        f"CASE WHEN r.v <> 17 THEN 'PCS' END AS productcode, 'N' || r.request_id AS firstname "
        f"FROM acct a JOIN req r ON r.request_id = a.request_id WHERE {REPORT.replace('request_id', 'r.request_id').replace('v NOT', 'r.v NOT')}",
    ),
)
def repeat_header(spark, sf):
    """Exploding keeps the request's own columns; nothing is joined."""
    return exploded(spark, sf, "user_id", "header", "header_lists", "header_rows", "inquiry").select(
        "request_id", "ordinal", "user_id", _header("ReportOrderNO").alias("reportnumber"),
        _header("ProductCode").alias("productcode"), F.col("inquiry.FirstName").alias("firstname"),
    )


@query(
    "enquiry_summary",
    q.with_ctes(
        d.REQ, d.ACCT,
        body=f"""SELECT {ID}, CAST(j AS INTEGER) AS ordinal,
  CASE WHEN request_id % 19 <> 0 THEN 'ALL' END AS purpose,
  CASE WHEN request_id % 19 <> 0 THEN CAST(request_id % 16 AS VARCHAR) END AS total,
  CASE WHEN request_id % 19 <> 0 THEN CAST(request_id % 2 AS VARCHAR) END AS past30days,
  CASE WHEN request_id % 19 <> 0 THEN CAST(request_id % 12 AS VARCHAR) END AS past12months,
  CASE WHEN request_id % 19 <> 0 THEN CAST(request_id % 16 AS VARCHAR) END AS past24months,
  CASE WHEN request_id % 19 <> 0 THEN 'r' || request_id % 3 END AS recent
FROM acct WHERE {REPORT}""",
    ),
)
def enquiry_summary(spark, sf):
    return exploded(spark, sf, "enquiry_summary").select(
        "request_id", "ordinal", *flatten.summary(),
    )


@query(
    "zip_arrays",
    q.with_ctes(
        d.REQ,
        "z AS (SELECT *, unnest(generate_series(0, greatest(header_rows, n_phones) - 1)) AS i FROM req WHERE v NOT IN (5, 17))",
        body=f"SELECT {ID}, CAST(i AS INTEGER) AS i, CASE WHEN i < header_rows THEN CASE i WHEN 0 THEN 'PCS' ELSE 'IDCR' END END AS productcode, "
        "CASE WHEN i < n_phones THEN CASE i WHEN 0 THEN '5' || request_id ELSE '6' || request_id END END AS number FROM z",
    ),
)
def zip_arrays(spark, sf):
    """Positional side-by-side of two lists of one request."""
    return flatten.header_rows(parsed(spark, sf, parts=()))


_RENAME_VALUES = {
    "acct_number": "CASE WHEN v <> 71 THEN 'A' || a END", "accounttype": "'T' || a % 5",
    "balance": "CASE WHEN v = 67 THEN NULL WHEN v = 31 AND j = n_acct - 1 THEN 'abc' WHEN a % 4 = 0 THEN '0' ELSE CAST(cents + j AS VARCHAR) END",
    "ownershiptype": "'Individual'", "pastdueamount": "CAST(a % 3 AS VARCHAR)",
    "highcredit": "CASE WHEN request_id % 6 >= 3 AND a % 4 <> 0 THEN '1' || a END",
    "creditlimit": "'3' || a", "sanctionamount": "CASE WHEN request_id % 6 NOT IN (0, 3) THEN '2' || a END",
    "writeoffamount": "CASE WHEN a % 41 = 0 THEN '500' END",
    "suitfiledstatus": "CASE WHEN request_id % 4 = 0 AND a % 2 = 0 THEN 'NS' END",
}


@query(
    "rename_accounts",
    q.with_ctes(
        d.REQ, d.ACCT,
        body=f"SELECT {ID}, CAST(j AS INTEGER) AS ordinal, "
        + ", ".join(f"CAST({_RENAME_VALUES.get(n, 'NULL')} AS VARCHAR) AS {n}" for n in flatten.ACCOUNT_NAMES.values())
        + f" FROM acct WHERE {REPORT}",
    ),
)
def rename_accounts(spark, sf):
    return exploded(spark, sf).select(
        "request_id", "ordinal", *flatten.renamed(F.col("a"))
    )


@query(
    "rename_nohit",
    q.with_ctes(
        d.REQ,
        body=f"SELECT {ID}, CASE WHEN v <> 17 THEN 'C' || request_id END AS client_id, "
        "CASE WHEN v <> 17 THEN 'ref' || request_id % 10 END AS reference_no, reportnumber, 'E' || request_id % 7 AS errorcode "
        "FROM req WHERE (route = 'INVALID' AND v <> 5) OR (route = 'NOHIT' AND v NOT IN (5, 23))",
    ),
)
def rename_nohit(spark, sf):
    error = F.coalesce("top_error", "report_error")
    return parsed(spark, sf).where(error.isNotNull()).select(
        "request_id", _header("ClientID").alias("client_id"), _header("CustRefField").alias("reference_no"),
        _header("ReportOrderNO").alias("reportnumber"), error["ErrorCode"].alias("errorcode"),
    )


@query(
    "score_extract",
    q.with_ctes(d.REQ, body=f"SELECT {ID}, v = 5 AS bad_json, CAST(CASE WHEN {REPORT} THEN score ELSE 99999 END AS BIGINT) AS score FROM req"),
)
def score_extract(spark, sf):
    score = parse.read_score(F.col("score_details"), CFG.missing_score)
    return parsed(spark, sf, parts=["ScoreDetails"]).select("request_id", "bad_json", score.alias("score"))


@query(
    "explode_enquiries",
    q.with_ctes(
        d.REQ, d.ENQ,
        body=f"""SELECT CAST(e.request_id AS VARCHAR) AS request_id, CAST(e AS VARCHAR) AS seq, 'E' || e % 3 AS institution,
  strftime(date, '%Y-%m-%d') AS day, '10:00' AS time, '00' AS requestpurpose, CAST(e.request_id + e AS VARCHAR) AS amount
FROM enq e JOIN req r ON r.request_id = e.request_id WHERE {REPORT.replace('request_id', 'r.request_id')}""",
    ),
)
def explode_enquiries(spark, sf):
    rows = flatten.enquiries(parsed(spark, sf, parts=["Enquiries"]), AS_OF)
    raw = F.col("raw")
    return rows.select(
        "request_id", raw["seq"].alias("seq"), raw["Institution"].alias("institution"),
        F.date_format("date", "yyyy-MM-dd").alias("day"), raw["Time"].alias("time"),
        raw["RequestPurpose"].alias("requestpurpose"), raw["Amount"].alias("amount"),
    )


@query(
    "feature_map",
    q.with_ctes(
        d.REQ,
        body=f"""SELECT {ID}, 'offline_bnpl_score' AS label, limit_score AS value FROM req WHERE v <> 5 AND limit_score IS NOT NULL
UNION ALL SELECT {ID}, 'offline_bnpl_limit', base_limit FROM req WHERE v <> 5
UNION ALL SELECT {ID}, 'other', 1.5 FROM req WHERE v <> 5
UNION ALL SELECT {ID}, 'extra', CASE WHEN v <> 83 THEN CAST(request_id AS DOUBLE) END FROM req WHERE v <> 5
UNION ALL SELECT {ID}, 'late', -2 FROM req WHERE v <> 5 AND request_id % 17 <> 0""",
    ),
)
def feature_map(spark, sf):
    bag = F.map_entries(parse.feature_map(F.col("features")))
    rows = parsed(spark, sf).select("request_id", F.explode(bag).alias("e"))
    return rows.select(
        "request_id", F.col("e.key").alias("label"), F.col("e.value").alias("value")
    )


# --- routing ----------------------------------------------------------------


@query(
    "route_input",
    q.with_ctes(
        d.REQ,
        body=f"SELECT {ID}, v = 5 AS bad_json, CASE WHEN v <> 5 AND request_id % 50 = 0 THEN 'Invalid_Detail' ELSE 'Valid_Detail' END AS input_detail_type, "
        "CASE WHEN v <> 5 AND request_id % 50 = 0 THEN 'E' || request_id % 7 END AS errorcode FROM req",
    ),
)
def route_input(spark, sf):
    return parsed(spark, sf).select(
        "request_id", "bad_json",
        F.when(documents.route() == "INVALID", "Invalid_Detail").otherwise("Valid_Detail").alias("input_detail_type"),
        F.col("top_error.ErrorCode").alias("errorcode"),
    )


@query(
    "route_history",
    q.with_ctes(
        d.REQ,
        "x AS (SELECT request_id, v, CASE WHEN v = 5 THEN 'HIT' ELSE route END AS route FROM req)",
        body=f"SELECT {ID}, v = 5 AS bad_json, route, CASE route WHEN 'INVALID' THEN 'NA' WHEN 'NOHIT' THEN 'NTC' ELSE 'ETC' END AS bur_hist_sta, "
        "CASE WHEN route = 'NOHIT' THEN 'not found' END AS errordesc FROM x",
    ),
)
def route_history(spark, sf):
    df = parsed(spark, sf).withColumn("route", documents.route())
    return df.select(
        "request_id", "bad_json", "route",
        policy.history_status(F.col("route"), F.lit(False)).alias("bur_hist_sta"),
        F.col("report_error.ErrorDesc").alias("errordesc"),
    )


# --- decisions --------------------------------------------------------------

_DECISION = "user_id, accept_ind, bureau_history_status, bnpl_limit, error_reason"


@query("decision_documents", q.with_ctes(*d.DECIDED, body=f"SELECT {ID}, {_DECISION} FROM judged"))
def decision_documents(spark, sf):
    """From JSON text to decisions in one stage, without a shuffle."""
    return documents.decide_documents(t.documents(spark, sf), AS_OF)


@query(
    "decision_launch",
    q.with_ctes(
        *d.DECIDED[:-1], d.judged(envelope=False),
        body=f"SELECT {ID}, accept_ind, bureau_history_status, error_reason FROM judged",
    ),
)
def decision_launch(spark, sf):
    """The launch profile on bare reports."""
    raw = t.documents(spark, sf, envelope=False)
    return documents.decide_documents(raw, AS_OF, cfgs.LAUNCH).drop("user_id", "bnpl_limit")


@query("decision_dated", q.decided_later(q.with_ctes(*d.DECIDED, body=f"SELECT {ID}, {_DECISION} FROM judged"), "request_id % 4"))
def decision_dated(spark, sf):
    """Every document is decided as of a date of its own, still in one stage."""
    raw = t.documents(spark, sf).withColumn("as_of", F.expr(fq.OWN_DATE.format(k="request_id")))
    return documents.decide_documents(raw, F.col("as_of"))


_STRICT = [
    d.REQ, d.ACCT, q.CELL, q.FLAG, fq.strict_enquiries(d.ENQ), fq.STRICT_METRIC, fq._STRICT_LIMIT[0],
    d.judged(limited=fq._STRICT_LIMIT[1]),
]
_OWN = f"SELECT {ID}, {_DECISION} FROM judged"


@query(
    "decision_policies",
    fq.side_by_side(
        current=q.with_ctes(*d.DECIDED, body=_OWN),
        launch=q.with_ctes(*d.DECIDED[:-1], d.judged(envelope=False), body=_OWN.replace("user_id", "NULL AS user_id")),
        strict=q.with_ctes(*_STRICT, body=_OWN),
    ),
)
def decision_policies(spark, sf):
    """Three policies on documents that are parsed once."""
    policies = {"current": CFG, "launch": cfgs.LAUNCH, "strict": fq.strict(fq.OTHER)}
    return documents.decide_policies(t.documents(spark, sf), AS_OF, policies)


def _twice(docs):
    """Every third document again, made once and in the file that its task writes."""
    copies = F.expr("sequence(0, if(CAST(request_id AS INT) % 3 = 0, 1, 0))")
    return docs.withColumn("copy", F.explode(copies))


@query(
    "request_ids",
    q.with_ctes(
        d.REQ,
        body="SELECT user_id, CAST(copy AS BIGINT) AS copy, true AS found_again FROM req "
        "CROSS JOIN (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR request_id % 3 = 0",
    ),
)
def request_ids(spark, sf):
    """Ids of lines, some of them equal, are found again after more files have come."""
    inbox, first = new_path(spark, "inbox"), new_path(spark, "ids")
    docs = t.documents(spark, sf)
    _twice(docs).select("value").write.option("compression", "gzip").text(inbox)
    user = F.when(F.col("value").endswith("}"), F.get_json_object("value", "$.user_id"))
    src.read_requests(spark, inbox, stable_ids=True).select("request_id", "digest", user.alias("user_id")).write.parquet(first)
    more = docs.where("CAST(request_id AS INT) % 5 = 0").select("value")
    more.write.mode("append").option("compression", "gzip").text(inbox)
    again = src.read_requests(spark, inbox, stable_ids=True)
    found = again.select("request_id", F.col("digest").alias("other"), F.lit(True).alias("found"))
    rows = spark.read.parquet(first).join(found, "request_id", "left")
    return rows.select(
        "user_id",
        F.substring_index("request_id", "#", -1).cast("bigint").alias("copy"),
        F.coalesce(F.col("found") & (F.col("digest") == F.col("other")), F.lit(False)).alias("found_again"),
    )


@query(
    "quarantine",
    q.with_ctes(*d.DECIDED, body=f"SELECT {ID}, user_id, error_reason FROM judged WHERE error_reason IS NOT NULL"),
)
def quarantine(spark, sf):
    return export.quarantine_table(documents.decide_documents(t.documents(spark, sf), AS_OF))


@query("stream_decision", q.with_ctes(*d.DECIDED, body=f"SELECT {_DECISION} FROM judged"))
def stream_decision(spark, sf):
    """The same decisions from a stream that reads the documents file by file."""
    inbox, out = new_path(spark, "inbox"), new_path(spark, "stream")
    # Files by the number of documents, not of partitions: each micro-batch costs seconds, however few documents it has.
    parts = t.parts_of(t.read(spark, sf, "customer").count(), 40_000, 8)
    t.documents(spark, sf, parts=parts).select("value").write.text(inbox)
    raw = src.stream_requests(spark, inbox, files_per_batch=4)
    run_stream(raw, out, f"{out}/_checkpoint", AS_OF).awaitTermination()
    return sinks.read_table(spark, out, "decision").select(*_DECISION.split(", "))


# --- output tables ----------------------------------------------------------


def _conformed(rows, fields):
    """In the fixed schema, dates as text for the comparison."""
    return export.dates_as_text(export.conform(rows, fields, keys=["request_id"]))


@query("conform_bureau", q.with_ctes(*d.DECIDED, d.PIVOT, body=d.bureau_table()))
def conform_bureau(spark, sf):
    return _conformed(export.account_table(scored(spark, sf), CFG), s.bureau_fields(CFG.user_column))


@query("conform_bureau_flat", q.with_ctes(*d.DECIDED, d.PIVOT, body=d.bureau_table()))
def conform_bureau_flat(spark, sf):
    """The same table from flat request, account and enquiry tables, made by one pass over the documents."""
    tables = ledger.tables_from_requests(parsed(spark, sf), AS_OF, CFG, saved=new_path(spark, "flat"))
    return _conformed(ledger.account_table(*tables, AS_OF, CFG), s.bureau_fields(CFG.user_column))


@query(
    "highcredit_presence",
    q.with_ctes(
        *d.DECIDED, d.PIVOT,
        body="SELECT request_id, acct_number, CASE WHEN CAST(request_id AS BIGINT) % 12 <> 0 THEN highcredit END AS highcredit, "
        "CASE WHEN CAST(request_id AS BIGINT) % 4 <> 1 THEN suitfiledstatus END AS suitfiledstatus "
        f"FROM ({d.bureau_table()}) AS bureau WHERE acct_number IS NOT NULL",
    ),
)
def highcredit_presence(spark, sf):
    """Keys that are sent as null on every account are there: no other field stands in for them."""
    sent = lambda key: F.replace(
        F.col("value"), F.lit('"RetailAccountDetails":[{'), F.lit(f'"RetailAccountDetails":[{{"{key}":null,')
    )
    k = F.col("request_id").cast("int")
    value = F.when(k % 12 == 0, sent("HighCredit")).when(k % 4 == 1, sent("SuitFiledStatus")).otherwise(F.col("value"))
    cfg = dataclasses.replace(CFG, key_presence=True)
    rows = documents.score_requests(parse.parse_requests(t.documents(spark, sf).withColumn("value", value), cfg), AS_OF, cfg)
    accounts = export.account_table(rows, cfg).where("acct_number IS NOT NULL")
    return accounts.select("request_id", "acct_number", "highcredit", "suitfiledstatus")


_ENQUIRY_SQL = q.with_ctes(
        *d.DECIDED,
        body=f"""SELECT CAST(e.request_id AS VARCHAR) AS request_id, CAST(e AS VARCHAR) AS seq, 'E' || e % 3 AS institution,
  CASE (e.request_id + e) % 4 WHEN 0 THEN strftime(date, '%Y-%m-%d') WHEN 1 THEN strftime(date, '%m/%d/%Y')
    WHEN 2 THEN strftime(date, '%m-%d-%Y') ELSE strftime(date, '%b %-d, %Y') END AS date,
  '10:00' AS time, '00' AS requestpurpose, CAST(e.request_id + e AS VARCHAR) AS amount,
  strftime(date, '%Y-%m-%d %H:%M:%S') AS date_n, {q.months_to('date')} <= 3 AS inq_flag
FROM enq e JOIN judged j ON j.request_id = e.request_id WHERE error_reason IS NULL AND route = 'HIT'""",
)


@query("conform_enquiry", _ENQUIRY_SQL)
def conform_enquiry(spark, sf):
    """Of the report only the enquiries are parsed in full."""
    rows = parse.parse_requests(t.documents(spark, sf), detail=("Enquiries",))
    rows = documents.score_requests(rows, AS_OF, CFG, detail=("enquiries",))
    return _conformed(export.enquiry_table(rows, AS_OF, CFG), s.ENQUIRY_OUT_FIELDS)


@query("conform_enquiry_flat", _ENQUIRY_SQL)
def conform_enquiry_flat(spark, sf):
    tables = ledger.tables_from_requests(parsed(spark, sf), AS_OF, CFG, saved=new_path(spark, "flat"))
    return _conformed(ledger.enquiry_table(*tables, AS_OF, CFG), s.ENQUIRY_OUT_FIELDS)


_USER = [n for n, _ in s.USER_POLICY_FIELDS]
_HAS_USER = "error_reason IS NULL AND route = 'HIT' AND n_usable > 0"


@query("conform_user_policy", q.with_ctes(*d.DECIDED, body=f"SELECT {ID}, {', '.join(_USER)} FROM judged WHERE {_HAS_USER}"))
def conform_user_policy(spark, sf):
    rows = export.user_policy_table(
        documents.score_requests(
            parse.parse_requests(t.documents(spark, sf), detail=False), AS_OF, detail=False
        )
    )
    return export.conform(rows, s.USER_POLICY_FIELDS, keys=["request_id"])


def _dict_sql() -> str:
    parts = []
    for name, kind in s.USER_POLICY_FIELDS:
        value = f"'\"' || {name} || '\"'" if kind == "string" else f"CAST({name} AS VARCHAR)"
        parts.append(f"'\"{name}\":{{\"0\":' || {value} || '}}'")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


@query("export_user_dict", q.with_ctes(*d.DECIDED, body=f"SELECT {ID}, {_dict_sql()} AS user_dict FROM judged WHERE {_HAS_USER}"))
def export_user_dict(spark, sf):
    """Column-oriented form: ``{column: {row index: value}}``."""
    df = documents.score_requests(
        parse.parse_requests(t.documents(spark, sf), detail=False), AS_OF, detail=False
    )
    dicts = F.to_json(export.column_dict(F.array("policy"), _USER))
    return df.where(F.col("policy").isNotNull()).select("request_id", dicts.alias("user_dict"))


_RESULT_DDL = (
    "accept_ind string, bureau_history_status string, bnpl_limit bigint, analytics_data struct<"
    "bur_processed_bnpl_data: struct<user_id: map<string,string>, acct_number: map<string,string>, "
    "acctst_l3m: map<string,int>>, enquiry_bnpl_data: struct<date_n: map<string,string>>, "
    "user_aggregated_policy_data: struct<cnt_accts: map<string,bigint>>>"
)


@query(
    "sink_result_json",
    q.with_ctes(
        *d.DECIDED,
        f"acc AS (SELECT f.request_id, string_agg('A' || f.a, ',' ORDER BY f.lag > 48, j) AS accounts, count(*) AS n, "
        f"string_agg(coalesce(CAST(l.p AS VARCHAR), '~'), ',' ORDER BY f.lag > 48, j) AS l3m "
        "FROM flag f LEFT JOIN level l ON l.acct = f.acct AND l.k = 3 AND l.lag <= 48 WHERE usable GROUP BY f.request_id)",
        body="""SELECT CASE WHEN route = 'HIT' AND coalesce(n_usable, 0) = 0 THEN NULL ELSE user_id END AS user_id,
  accept_ind, bureau_history_status, bnpl_limit,
  CASE WHEN route = 'HIT' THEN coalesce(accounts, '') ELSE CASE WHEN greatest(header_rows, n_phones) = 2 THEN '~,~' ELSE '~' END END AS accounts,
  CASE WHEN route = 'HIT' THEN coalesce(l3m, '') ELSE CASE WHEN greatest(header_rows, n_phones) = 2 THEN '~,~' ELSE '~' END END AS l3m,
  CAST(CASE WHEN route = 'HIT' AND judged.request_id % 16 <> 0 THEN judged.request_id % 16 ELSE 0 END AS INTEGER) AS n_enquiries,
  CASE WHEN route = 'HIT' AND n_usable > 0 THEN cnt_accts END AS cnt_accts
FROM judged LEFT JOIN acc USING (request_id) WHERE error_reason IS NULL""",
    ),
)
def sink_result_json(spark, sf):
    """Write the result documents, read them back."""
    path = new_path(spark, "results")
    sinks.write_result_documents(export.result_documents(scored(spark, sf), AS_OF, CFG), path)
    r = spark.read.text(path).select(F.from_json("value", _RESULT_DDL).alias("r")).select("r.*")
    bureau = F.col("analytics_data.bur_processed_bnpl_data")
    texts = lambda c: F.array_join(F.map_values(c).cast("array<string>"), ",", "~")
    return r.select(
        F.try_element_at(bureau["user_id"], F.lit("0")).alias("user_id"),
        "accept_ind", "bureau_history_status", "bnpl_limit",
        texts(bureau["acct_number"]).alias("accounts"), texts(bureau["acctst_l3m"]).alias("l3m"),
        F.coalesce(F.array_size(F.map_keys("analytics_data.enquiry_bnpl_data.date_n")), F.lit(0)).alias("n_enquiries"),
        F.try_element_at(
            F.col("analytics_data.user_aggregated_policy_data.cnt_accts"), F.lit("0")
        ).alias("cnt_accts"),
    )


_LAUNCH_DDL = (
    "Bur_Hist_Sta string, Accpt_Ind string, Bur_Data struct<ACCT_NUMBER: map<string,string>, "
    "AcctSt_L3M: map<string,int>, DATEOPENED_N: map<string,string>>, "
    "Enq_Data struct<Date_N: map<string,string>>, df_User struct<Cnt_Accts: map<string,bigint>>"
)


@query(
    "sink_result_launch",
    q.with_ctes(
        *d.DECIDED[:-1], d.judged(envelope=False),
        "acc AS (SELECT f.request_id, string_agg('A' || f.a, ',' ORDER BY f.lag > 48, j) AS accounts, "
        "string_agg(strftime(f.opened, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY f.lag > 48, j) AS opened, "
        "string_agg(coalesce(CAST(l.p AS VARCHAR), '~'), ',' ORDER BY f.lag > 48, j) AS l3m "
        "FROM flag f LEFT JOIN level l ON l.acct = f.acct AND l.k = 3 AND l.lag <= 48 WHERE usable GROUP BY f.request_id)",
        body="""SELECT bureau_history_status, accept_ind,
  CASE WHEN route = 'HIT' THEN coalesce(accounts, '') ELSE CASE WHEN greatest(header_rows, n_phones) = 2 THEN '~,~' ELSE '~' END END AS accounts,
  CASE WHEN route = 'HIT' THEN coalesce(l3m, '') ELSE CASE WHEN greatest(header_rows, n_phones) = 2 THEN '~,~' ELSE '~' END END AS l3m,
  CASE WHEN route = 'HIT' THEN coalesce(opened, '') ELSE CASE WHEN greatest(header_rows, n_phones) = 2 THEN '~,~' ELSE '~' END END AS opened,
  CAST(CASE WHEN route = 'HIT' AND judged.request_id % 16 <> 0 THEN judged.request_id % 16 ELSE 0 END AS INTEGER) AS n_enquiries,
  CASE WHEN route = 'HIT' AND n_usable > 0 THEN reportnumber END AS reportnumber,
  CASE WHEN route = 'HIT' AND n_usable > 0 THEN cnt_accts END AS cnt_accts
FROM judged LEFT JOIN acc USING (request_id) WHERE error_reason IS NULL""",
    ),
)
def sink_result_launch(spark, sf):
    """Launch documents: five keys, the launch spelling, the user table by report number."""
    path, cfg = new_path(spark, "launch-results"), cfgs.LAUNCH
    raw = t.documents(spark, sf, envelope=False)
    done = documents.score_requests(parse.parse_requests(raw, cfg), AS_OF, cfg)
    sinks.write_result_documents(export.result_documents(done, AS_OF, cfg), path)
    r = spark.read.text(path).select(F.from_json("value", _LAUNCH_DDL).alias("r")).select("r.*")
    texts = lambda c: F.array_join(F.map_values(c).cast("array<string>"), ",", "~")
    user = F.map_entries("df_User.Cnt_Accts")
    return r.select(
        F.col("Bur_Hist_Sta").alias("bureau_history_status"), F.col("Accpt_Ind").alias("accept_ind"),
        texts(F.col("Bur_Data.ACCT_NUMBER")).alias("accounts"), texts(F.col("Bur_Data.AcctSt_L3M")).alias("l3m"),
        texts(F.col("Bur_Data.DATEOPENED_N")).alias("opened"),
        F.coalesce(F.array_size(F.map_keys("Enq_Data.Date_N")), F.lit(0)).alias("n_enquiries"),
        F.get(user, F.lit(0))["key"].alias("reportnumber"), F.get(user, F.lit(0))["value"].alias("cnt_accts"),
    )


@query(
    "duplicate_requests",
    q.with_ctes(
        *d.DECIDED,
        body="SELECT user_id, accept_ind, bureau_history_status, bnpl_limit, error_reason, form FROM judged "
        "CROSS JOIN (VALUES ('document'), ('table')) AS forms(form) "
        "CROSS JOIN (VALUES (0), (1)) AS copies(copy) WHERE (copy = 0 OR request_id % 3 = 0) AND "
        "(form = 'document' OR error_reason IS NULL)",
    ),
)
def duplicate_requests(spark, sf):
    """Every third document is submitted twice; both forms decide each submission for itself."""
    path = new_path(spark, "duplicates")
    _twice(t.documents(spark, sf)).select("value").write.text(path)
    raw = src.read_requests(spark, path)
    nested = documents.decide_documents(raw, AS_OF, CFG)
    tables = ledger.tables_from_requests(parse.parse_requests(raw, CFG), AS_OF, CFG, saved=new_path(spark, "flat"))
    flat = ledger.decide_tables(*tables, AS_OF, CFG).where("error_reason IS NULL")
    columns = _DECISION.split(", ")
    return nested.select(*columns, F.lit("document").alias("form")).unionByName(
        flat.select(*columns, F.lit("table").alias("form"))
    )


@query(
    "sink_tables",
    q.with_ctes(
        *d.DECIDED,
        body="SELECT user_id, accept_ind, error_reason, CASE WHEN request_id % 2 = 0 THEN 'even' ELSE 'odd' END AS run, "
        "strftime(DATE '2024-01-31', '%Y-%m-%d') AS as_of FROM judged",
    ),
)
def sink_tables(spark, sf):
    """Two inputs under one date stand side by side; a run repeated under its name is not doubled."""
    out = new_path(spark, "tables")
    docs = t.documents(spark, sf)
    for run, rest in (("even", 0), ("odd", 1), ("even", 0)):
        run_batch(docs.where(f"CAST(request_id AS INT) % 2 = {rest}"), out, AS_OF, CFG, run=run)
    rows = sinks.read_table(spark, out, "decision")
    return rows.select("user_id", "accept_ind", "error_reason", "run", F.date_format("as_of", "yyyy-MM-dd").alias("as_of"))
