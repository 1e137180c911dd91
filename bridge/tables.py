"""Bureau-shaped Spark tables and documents derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bridge import shapes as sh
from bridge.shapes import SPARK


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def spread(scan: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Deal out the few narrow columns of a test file, which is one split.

    Every row fans out to a whole history below. Only the making of test data needs this.
    """
    return scan.repartition(parts or int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def parts_of(rows: int, size: int, least: int) -> int:
    """Parts (files, buckets) of about ``size`` rows, ``least`` of them for few rows."""
    return max(least, -(-rows // size))


# --- flat tables ------------------------------------------------------------


def requests(spark: SparkSession, sf: str) -> DataFrame:
    k, seg = "c_custkey", "c_mktsegment"
    return read(spark, sf, "customer").selectExpr(
        f"{k} AS request_id",
        f"concat('R', {k}) AS reportnumber",
        f"{sh.route(k)} AS route",
        f"CAST({sh.score(k)} AS BIGINT) AS score",
        f"{sh.limit_score(k)} AS limit_score",
        f"{sh.base_limit('c_acctbal')} AS base_limit",
        f"{sh.min_income(k, seg)} AS min_income",
        f"{sh.max_income(k, seg)} AS max_income",
    )


def _codes(formula: str) -> str:
    return f"transform(sequence(0, n_hist - 1), i -> {formula})"


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """One account per order, with its raw code histories."""
    k, a = "o_custkey", "o_orderkey"
    columns = [k, a, "o_orderdate", "o_orderstatus", "o_totalprice"]
    orders = spread(read(spark, sf, "orders").select(*columns), a)
    shaped = orders.selectExpr(
        "*",
        f"CAST({a} % 53 AS INT) AS lag_shape",
        f"CAST(12 + {a} % 37 AS INT) AS n_hist",
    ).selectExpr(
        f"{k} AS request_id",
        f"{a} AS acct_number",
        f"{sh.opened(k, a, 'o_orderdate', SPARK)} AS opened",
        f"{sh.months_before('lag_shape', SPARK)} AS reported",
        f"CASE WHEN o_orderstatus = 'F' THEN {sh.months_before('lag_shape', SPARK)} END AS closed",
        "CASE WHEN o_orderstatus = 'F' THEN 0D ELSE o_totalprice END AS balance",
        f"CASE WHEN {a} % 97 = 0 THEN o_totalprice END AS writeoff",
        f"CASE WHEN {k} % 6 >= 3 AND {a} % 4 <> 0 THEN o_totalprice + 1 END AS highcredit",
        f"CASE WHEN {k} % 6 NOT IN (0, 3) THEN o_totalprice + 2 END AS sanctionamount",
        "o_totalprice AS creditlimit",
        f"CASE WHEN {k} % 4 = 0 AND {a} % 2 = 0 THEN 'NS' END AS suit_status",
        f"{_codes(sh.payment(k, a, 'i'))} AS payment",
        f"{_codes(sh.suit(a, 'i'))} AS suit",
        f"{_codes(sh.asset(a, 'i'))} AS asset",
    )
    return shaped


def enquiries(spark: SparkSession, sf: str) -> DataFrame:
    month = sh.months_before("(event_id % 40)", SPARK)
    return read(spark, sf, "events").selectExpr(
        "event_id",
        "user_id AS request_id",
        f"CASE WHEN event_id % 101 <> 0 THEN {month} END AS date",
    )


# --- request documents ------------------------------------------------------


def _seeds(spark: SparkSession, sf: str, table: str, parts: int | None = None) -> DataFrame:
    if table == "customer":
        rows = read(spark, sf, table).selectExpr(
            "c_custkey AS k", "c_acctbal AS bal", "c_mktsegment AS seg"
        )
    else:
        rows = read(spark, sf, "supplier").selectExpr(
            "s_suppkey AS k", "s_acctbal AS bal", "'BUILDING' AS seg"
        )
    return spread(rows, "k", parts)


def _date_text(day: str, style: str) -> str:
    return (
        f"CASE {style} WHEN 0 THEN date_format({day}, 'yyyy-MM-dd') "
        f"WHEN 1 THEN date_format({day}, 'dd-MM-yyyy') "
        f"WHEN 2 THEN date_format({day}, 'dd/MM/yyyy') "
        f"WHEN 3 THEN date_format({day}, \"yyyy-MM-dd '10:20:30'\") "
        f"WHEN 4 THEN date_format({day}, 'd-MMM-yyyy') "
        f"ELSE date_format({day}, 'yyyyMMdd') END"
    )


def _months(k: str, a: str) -> str:
    """The longest history of an account; each place keeps the few conditions that can hold there."""
    return "array(" + ", ".join(
        f"named_struct('key', 'm{i}', 'PaymentStatus', {sh.payment(k, a, str(i))}, "
        f"'SuitFiledStatus', {sh.suit(a, str(i))}, 'AssetClassificationStatus', {sh.asset(a, str(i))})"
        for i in range(49)
    ) + ")"


_STORED: dict[tuple[str, str, bool], str] = {}


def store_documents(spark: SparkSession, sf: str, path: str, table: str = "customer", envelope: bool = True) -> None:
    """Write the documents once; ``documents`` then reads them, so timing leaves out their making."""
    documents(spark, sf, table, envelope).write.parquet(path)
    _STORED[sf, table, envelope] = path


def documents(
    spark: SparkSession, sf: str, table: str = "customer", envelope: bool = True, parts: int | None = None
) -> DataFrame:
    """One JSON request document per customer (or supplier), made in ``parts`` tasks.

    Every document has its own accounts, histories, phones, enquiries and
    features; a few are broken in the ways the engine has to survive.
    """
    if (sf, table, envelope) in _STORED:
        return spark.read.parquet(_STORED[sf, table, envelope])
    v, a, day = "(k % 97)", "(k * 5 + j)", sh.doc_opened("k", "(k * 5 + j)", SPARK)
    lag, closed = sh.doc_lag("k", a, "j"), sh.doc_closed_ago("k", a, "j")
    opened_text = (
        f"CASE WHEN {a} % 31 = 0 THEN 'not a date' ELSE {_date_text(day, f'({a} % 6)')} END"
    )
    cents = "CAST(abs(round(bal * 100)) AS BIGINT)"
    balance = (
        f"CASE WHEN {v} = 67 THEN NULL WHEN {v} = 31 AND j = n_acct - 1 THEN 'abc' "
        f"WHEN {a} % 4 = 0 THEN '0' ELSE CAST({cents} + j AS STRING) END"
    )
    # The months of most accounts depend on no more than a % 5, so they are two literals.
    months = (
        f"CASE WHEN {sh.marked('k', a)} THEN {_months('k', a)} "
        f"WHEN {a} % 5 = 0 THEN {_months('1', '5')} ELSE {_months('1', '1')} END"
    )
    history = f"CASE WHEN {v} <> 29 THEN slice({months}, 1, CAST(12 + {a} % 38 AS INT)) END"
    account = (
        "named_struct("
        f"'seq', CAST(j + 1 AS STRING), "
        f"'AccountNumber', CASE WHEN {v} <> 71 THEN concat('A', {a}) END, "
        f"'Institution', concat('I', {a} % 7), 'AccountType', concat('T', {a} % 5), "
        f"'OwnershipType', 'Individual', 'Balance', {balance}, "
        f"'PastDueAmount', CAST({a} % 3 AS STRING), 'Open', CASE WHEN {a} % 3 = 0 THEN 'No' ELSE 'Yes' END, "
        f"'HighCredit', CASE WHEN k % 6 >= 3 AND {a} % 4 <> 0 THEN concat('1', {a}) END, "
        f"'SanctionAmount', CASE WHEN k % 6 NOT IN (0, 3) THEN concat('2', {a}) END, "
        f"'CreditLimit', concat('3', {a}), "
        f"'SuitFiledStatus', CASE WHEN k % 4 = 0 AND {a} % 2 = 0 THEN 'NS' END, "
        f"'WriteOffAmount', CASE WHEN {a} % 41 = 0 THEN '500' END, "
        f"'DateOpened', {opened_text}, "
        f"'DateReported', date_format({sh.months_before(lag, SPARK)}, 'yyyy-MM-dd'), "
        f"'DateClosed', date_format({sh.months_before(closed, SPARK)}, 'dd-MM-yyyy'), "
        f"'CollateralType', CASE WHEN {a} % 8 = 0 THEN 'Gold' END, "
        f"'History48Months', {history})"
    )
    enquiry_day = f"{sh.months_before('((k + e) % 9)', SPARK)} + CAST((k + e) % 28 AS INT)"
    enquiry = (
        "named_struct('seq', CAST(e AS STRING), 'Institution', concat('E', e % 3), 'Date', "
        f"CASE (k + e) % 4 WHEN 0 THEN date_format({enquiry_day}, 'yyyy-MM-dd') "
        f"WHEN 1 THEN date_format({enquiry_day}, 'MM/dd/yyyy') "
        f"WHEN 2 THEN date_format({enquiry_day}, 'MM-dd-yyyy') "
        f"ELSE date_format({enquiry_day}, 'MMM d, yyyy') END, "
        "'Time', '10:00', 'RequestPurpose', '00', 'Amount', CAST(k + e AS STRING))"
    )
    score = sh.score("k")
    report = (
        "named_struct("
        f"'RetailAccountDetails', transform(slice(sequence(0, 4), 1, n_acct), j -> {account}), "
        f"'ScoreDetails', CASE WHEN {v} = 59 THEN array(named_struct('Value', 'N/A')) "
        f"WHEN k % 13 <> 0 THEN array(named_struct('Value', CAST({score} AS STRING))) END, "
        "'EnquirySummary', CASE WHEN k % 19 <> 0 THEN named_struct('Purpose', 'ALL', "
        "'Total', CAST(k % 16 AS STRING), 'Past30Days', CAST(k % 2 AS STRING), "
        "'Past12Months', CAST(k % 12 AS STRING), 'Past24Months', CAST(k % 16 AS STRING), "
        "'Recent', concat('r', k % 3)) END, "
        f"'Enquiries', CASE WHEN k % 16 <> 0 THEN transform(sequence(0, CAST(k % 16 AS INT) - 1), e -> {enquiry}) END)"
    )
    error = "named_struct('ErrorCode', concat('E', k % 7), 'ErrorDesc', 'not found')"
    phones = (
        "CASE WHEN k % 23 = 5 THEN array(named_struct('seq', '1', 'PhoneType', '[\"M\"]', 'Number', concat('5', k)), "
        "named_struct('seq', '2', 'PhoneType', 'Home', 'Number', concat('6', k))) "
        "ELSE array(named_struct('seq', '1', 'PhoneType', 'Work', 'Number', concat('5', k))) END"
    )
    bureau = (
        "named_struct("
        f"'Error', CASE WHEN {sh.route('k')} = 'INVALID' THEN {error} END, "
        f"'InquiryResponseHeader', CASE WHEN {v} <> 17 THEN named_struct('ClientID', concat('C', k), "
        "'CustRefField', concat('ref', k % 10), "
        f"'ReportOrderNO', CASE WHEN {v} <> 47 THEN concat('R', k) END, "
        "'ProductCode', CASE WHEN k % 10 = 9 THEN array('PCS', 'IDCR') ELSE array('PCS') END, "
        "'SuccessCode', '1', 'Date', '2024-01-31', 'Time', '09:08:07') END, "
        "'InquiryRequestInfo', named_struct('InquiryPurpose', 'PL', 'FirstName', concat('N', k), "
        f"'LastName', CASE WHEN k % 2 = 0 THEN 'L' END, 'InquiryPhones', {phones}), "
        f"'CCRResponse', CASE WHEN {v} <> 23 THEN named_struct('CIRReportDataLst', array(named_struct("
        f"'Error', CASE WHEN {sh.route('k')} = 'NOHIT' THEN {error} END, "
        f"'CIRReportData', CASE WHEN {sh.route('k')} <> 'NOHIT' THEN {report} END))) END)"
    )
    label = lambda name, value: f"named_struct('label', '{name}', 'value', {value})"
    features = (
        f"map('model', CASE WHEN {v} = 53 THEN array({label('other', "'1.5'")}) ELSE array("
        f"{label('offline_bnpl_score', f'CAST({sh.limit_score("k")} AS STRING)')}, {label('other', "'1.5'")}) END, "
        f"'base', array({label('offline_bnpl_limit', f'CAST({sh.base_limit("bal")} AS STRING)')}, "
        f"{label('extra', f"CASE WHEN {v} = 83 THEN 'oops' ELSE CAST(k AS STRING) END")}), "
        f"'late', CASE WHEN k % 17 = 0 THEN array({label('offline_bnpl_score', "'950'")}) ELSE array({label('late', "'-2'")}) END)"
    )
    whole = (
        "named_struct('user_id', concat('U', k), "
        f"'ftpl_features', {features}, "
        f"'employment_details', CASE WHEN {v} <> 11 THEN named_struct("
        f"'min_monthly_income', {sh.min_income('k', 'seg')}, 'max_monthly_income', {sh.max_income('k', 'seg')}) END, "
        f"'bureau_data', {bureau})"
    )
    text = f"to_json({whole if envelope else bureau})"
    # The listed phone type is written as a real JSON list; only these documents are searched for it.
    listed = F.replace(F.col("doc"), F.lit('"[\\"M\\"]"'), F.lit('["M"]'))
    seeds = _seeds(spark, sf, table, parts).selectExpr("*", f"CAST({sh.doc_accounts('k', SPARK)} AS INT) AS n_acct")
    return seeds.selectExpr("CAST(k AS STRING) AS request_id", f"{v} AS v", "k % 23 = 5 AS two_phones", f"{text} AS doc").select(
        "request_id",
        F.when(F.col("v") == 5, F.expr("substring(doc, 1, length(doc) - 10)"))
        .when(F.col("two_phones"), listed)
        .otherwise(F.col("doc"))
        .alias("value"),
    )
