"""Output tables and result documents of scored requests."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions import history as h
from tradeline.functions.codes import code_levels
from tradeline.functions.dates import date_text, tenure_months
from tradeline.operators import parse, policy

Getter = Callable[[str], Column]


def conform(df: DataFrame, fields: Iterable[tuple[str, str]], keys: Iterable[str] = ()) -> DataFrame:
    """Fixed output schema: keep known columns, drop others, add missing as null.

    Names are lower-cased and NaN becomes null. ``keys`` lead the output.
    """
    have = {name.lower(): name for name in df.columns}
    double = {name.lower() for name, kind in df.dtypes if kind in ("double", "float")}

    def column(name: str, kind: str) -> Column:
        if name not in have:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(have[name])
        c = F.when(~F.isnan(c), c) if name in double else c
        return c.cast(kind).alias(name)

    return df.select(*keys, *[column(n.lower(), k) for n, k in fields])


def dates_as_text(df: DataFrame) -> DataFrame:
    """Date columns as they are written in documents."""
    return df.withColumns({n: date_text(F.col(n)) for n in df.columns if n in s.DATE_COLUMNS})


# --- decision ---------------------------------------------------------------


def decision_table(scored: DataFrame) -> DataFrame:
    return scored.select(*[n for n, _ in s.DECISION_FIELDS])


def quarantine_table(scored: DataFrame) -> DataFrame:
    """Requests that could not be processed, with the reason."""
    return scored.where(F.col("error_reason").isNotNull()).select(
        "request_id", "user_id", "error_reason"
    )


# --- account table ----------------------------------------------------------


def highcredit(high: Column, sanction: Column, limit: Column, any_known: Column) -> Column:
    """High credit, else sanctioned amount.

    The credit limit stands in only when no account of the report
    (``any_known = false``) has one of the other two.
    """
    return F.when(any_known, F.coalesce(high, sanction)).otherwise(limit)


def suit_filed(status: Column, first_month: Column, any_status: Column, cfg: PolicyConfig) -> Column:
    """Account-level status when the report has any, else that of month 0."""
    if not cfg.suit_from_account:
        return first_month
    return F.when(any_status, status).otherwise(first_month)


def account_rows() -> Column:
    """Rows of the account table as an array of (head, acct) structs.

    A report with history gives its surviving accounts; a no-hit or invalid
    request gives one row per header row (products x phones).
    """
    accounts = F.col("accounts")
    no_account = F.when(F.lit(False), F.get(accounts, F.lit(0)))
    heads = F.greatest(F.col("header_rows"), F.array_size("phones"))
    hit = F.transform(
        accounts, lambda a: F.struct(F.lit(0).alias("head"), a.alias("acct"))
    )
    # sequence(0, -1) would count down, so an empty header is cut off by slice.
    bare = F.transform(
        F.slice(F.sequence(F.lit(0), F.greatest(heads, F.lit(1))), F.lit(1), heads),
        lambda i: F.struct(i.alias("head"), no_account.alias("acct")),
    )
    return F.when(F.col("error_reason").isNull(), F.when(F.col("route") == "HIT", hit).otherwise(bare))


def _bind(row: Getter, cfg: PolicyConfig) -> dict[str, Column]:
    """Arrays that many output columns index, built once per row."""
    acct = row("acct")
    lag = acct["lag"]

    def named(series: str, table) -> Column:
        return h.reanchor(code_levels(acct[series], table), lag)

    return {
        "head": row("head"),
        "acct": acct,
        "raw": acct["raw"],
        "phone": F.get(F.col("phones"), row("head")),
        "suitst": named("suit", cfg.suit_codes),
        "acctst": named("payment", cfg.payment_codes),
        "assetst": named("asset", cfg.asset_codes),
    }


def _bureau_columns(b: Getter, cfg: PolicyConfig) -> dict[str, Column]:
    """All 271 output columns of one bound row."""
    acct, raw, phone = b("acct"), b("raw"), b("phone")
    head, any_acct = b("head"), b("acct").isNotNull()
    hit = F.col("route") == "HIT"

    def header(name: str) -> Column:
        return parse.header_at(name, head)

    def inquiry(name: str) -> Column:
        return F.when(head < F.array_size("phones"), F.col("inquiry")[name])

    error = F.when(F.col("route") == "INVALID", F.col("top_error")).otherwise(F.col("report_error"))
    error_text = lambda n: F.when(~hit & (head == 0), error[n])
    closed, opened, reported = acct["closed"], acct["opened"], acct["reported"]
    by_close, by_report = tenure_months(closed, opened), tenure_months(reported, opened)
    summary = lambda n: F.when(any_acct, F.col("enquiry_summary")[n])

    out = {
        "client_id": header("ClientID"),
        "reference_no": header("CustRefField"),
        cfg.user_column: F.col("user_id"),
        "reportnumber": header("ReportOrderNO"),
        "productcode": header("ProductCode"),
        "successcode": header("SuccessCode"),
        "date": header("Date"),
        "time": header("Time"),
        "inquirypurpose": inquiry("InquiryPurpose"),
        "firstname": inquiry("FirstName"),
        "lastname": inquiry("LastName"),
        "customfields": inquiry("CustomFields"),
        "phonetype": parse.phone_type(phone["PhoneType"], cfg.normalise_phone),
        "number": phone["Number"],
        "input_detail_type": F.when(F.col("route") == "INVALID", "Invalid_Detail").otherwise("Valid_Detail"),
        "errorcode": error_text("ErrorCode"),
        "errordesc": error_text("ErrorDesc"),
        "bur_hist_sta": F.when(F.col("route") == "NOHIT", "NTC").when(hit, "ETC"),
        "acct_number": raw["AccountNumber"],
        "balance": acct["balance"],
        "writeoffamount": acct["writeoff"],
        "highcredit": F.when(
            any_acct,
            highcredit(raw["HighCredit"], raw["SanctionAmount"], raw["CreditLimit"], F.col("high_known")),
        ),
        "suitfiledstatus": F.when(
            any_acct,
            suit_filed(
                raw["SuitFiledStatus"], F.get(acct["suit"], F.lit(0)), F.col("facts.any_suit_status"), cfg
            ),
        ),
        "days_past_due": acct["dpd"],
        "acct_uniq_id": acct["ordinal"],
        "acct_st_49": F.get(acct["payment"], F.lit(48)),
        "suit_filed_st_49": F.get(acct["suit"], F.lit(48)),
        "asset_cl_st_49": F.get(acct["asset"], F.lit(48)),
        "dateopened_n": opened,
        "dateclosed_n": closed,
        "datereported_n": reported,
        "acct_mob": acct["mob"],
        "score": F.when(any_acct, F.col("score")),
        "tenure_clo_ope": by_close,
        "tenure_rep_ope": by_report,
        "tenure_avai": F.coalesce(by_close, by_report),
        "non_avail_per": acct["lag"],
        "sco_pol": F.when(any_acct, policy.score_passes(F.col("score"), cfg)),
        "inq_flag": F.when(any_acct, F.col("inq_flag")),
    }
    # Account fields that keep their value under an upper-cased name.
    for name in (
        "seq", "Institution", "AccountType", "OwnershipType", "PastDueAmount", "Open",
        "LastPaymentDate", "CreditLimit", "AccountStatus", "source", "LastPayment",
        "SanctionAmount", "RepaymentTenure", "TermFrequency", "InstallmentAmount", "Reason",
        "AssetClassification", "InterestRate", "CollateralType", "CollateralValue",
    ):
        out[name.lower()] = raw[name]
    for name in s.SUMMARY_FIELDS:
        out[name.lower()] = summary(name)
    for name in ("perf_avail", "derog_pol", "act_acct_pol", "dpd90_pol_l12m", "dpd60_pol_l12m",
                 "dpd30_pol_l6m", "dpd30_pol_l12m", "dpd30_pol_l12m_cnt", "dpd30_pol_l6m_cnt",
                 "dpd30_pol_l3m_cnt"):
        out[name] = acct[name]
    keys = raw["History48Months"]["key"]
    for i in range(h.GRID):
        out[f"key_{i}"] = F.get(keys, F.lit(i))
        for series in ("suitst", "acctst", "assetst"):
            out[f"{series}_l{i}m"] = F.get(b(series), F.lit(i))
    return {n: out[n].cast(kind) for n, kind in s.bureau_fields(cfg.user_column)}


def account_table(scored: DataFrame, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """One row per account, 271 columns, keyed by request_id."""
    return account_columns(scored.withColumn("row", F.explode(account_rows())), cfg)


def account_columns(
    rows: DataFrame, cfg: PolicyConfig = CURRENT, keys: Iterable[str] = ("request_id",)
) -> DataFrame:
    """The account table of rows that hold one (head, acct) struct ``row`` and the request's fields."""
    bound = rows.withColumn(
        "b", F.struct(*[v.alias(n) for n, v in _bind(lambda n: F.col("row")[n], cfg).items()])
    )
    columns = _bureau_columns(lambda n: F.col("b")[n], cfg)
    return bound.select(*keys, *[v.alias(n) for n, v in columns.items()])


# --- enquiry and user tables ------------------------------------------------


def enquiry_columns(e: Column, as_of, cfg: PolicyConfig) -> dict[str, Column]:
    out = {n.lower(): e["raw"][n] for n in s.ENQUIRY_FIELDS}
    out["date_n"] = e["date"]
    out["inq_flag"] = policy.is_recent_enquiry(e["date"], as_of, cfg)
    return {n: out[n].cast(kind) for n, kind in s.ENQUIRY_OUT_FIELDS}


def enquiry_table(scored: DataFrame, as_of, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """One row per enquiry, 8 columns, keyed by request_id."""
    rows = scored.withColumn("e", F.explode("enquiries"))
    columns = enquiry_columns(F.col("e"), as_of, cfg)
    return rows.select("request_id", *[v.alias(n) for n, v in columns.items()])


def user_policy_table(scored: DataFrame) -> DataFrame:
    """One row per request with usable accounts, 26 columns, keyed by request_id."""
    return scored.where(F.col("policy").isNotNull()).select("request_id", "policy.*")


# --- result documents -------------------------------------------------------


def column_dict(rows: Column, fields: Iterable[str], names: dict[str, str] | None = None) -> Column:
    """Array of structs -> struct of ``{row index: value}`` maps, one per field."""
    names = names or {}

    def value(x: Column, name: str) -> Column:
        return date_text(x[name]) if name in s.DATE_COLUMNS else x[name]

    def entries(name: str) -> Column:
        return F.map_from_entries(
            F.transform(
                rows, lambda x, i: F.struct(i.cast("string").alias("i"), value(x, name).alias("v"))
            )
        )

    return F.when(rows.isNotNull(), F.struct(*[entries(n).alias(names.get(n, n)) for n in fields]))


def with_result_arrays(scored: DataFrame, as_of, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Add the tables as nested arrays: bureau_rows, enquiry_rows."""

    def struct(columns: dict[str, Column]) -> Column:
        return F.struct(*[v.alias(n) for n, v in columns.items()])

    bound = scored.withColumn(
        "bound_rows", F.transform(account_rows(), lambda r: struct(_bind(lambda n: r[n], cfg)))
    )
    return bound.withColumns(
        {
            "bureau_rows": F.transform(
                "bound_rows", lambda b: struct(_bureau_columns(lambda n: b[n], cfg))
            ),
            "enquiry_rows": F.transform(
                "enquiries", lambda e: struct(enquiry_columns(e, as_of, cfg))
            ),
        }
    )


def user_document(cfg: PolicyConfig = CURRENT) -> Column:
    """The user table of a result document, from column ``policy``: by row, at launch by report number."""
    if cfg.envelope:
        rows = F.when(F.col("policy").isNotNull(), F.array("policy"))
        return column_dict(rows, [n for n, _ in s.USER_POLICY_FIELDS])
    names = s.launch_names(cfg.user_column)
    values = [
        F.create_map(F.col("reportnumber"), F.col("policy")[n]).alias(names[n])
        for n, _ in s.USER_POLICY_FIELDS
        if n != "reportnumber"
    ]
    return F.when(F.col("policy").isNotNull(), F.struct(*values))


def result_documents(scored: DataFrame, as_of, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """``request_id, value``: one JSON result document per request.

    The launch profile uses its own five keys and column spelling, and indexes
    the user table by report number. Quarantined requests have no document.
    """
    names = None if cfg.envelope else s.launch_names(cfg.user_column)
    df = with_result_arrays(scored.where(F.col("error_reason").isNull()), as_of, cfg)
    fields = s.bureau_fields(cfg.user_column)
    bureau = column_dict(F.col("bureau_rows"), [n for n, _ in fields], names)
    enquiry = column_dict(F.col("enquiry_rows"), [n for n, _ in s.ENQUIRY_OUT_FIELDS], names)
    user = user_document(cfg)
    if cfg.envelope:
        body = F.struct(
            F.col("accept_ind"),
            F.col("bureau_history_status"),
            F.col("bnpl_limit"),
            F.struct(
                bureau.alias("bur_processed_bnpl_data"),
                enquiry.alias("enquiry_bnpl_data"),
                user.alias("user_aggregated_policy_data"),
            ).alias("analytics_data"),
        )
    else:
        body = F.struct(
            F.col("bureau_history_status").alias("Bur_Hist_Sta"),
            bureau.alias("Bur_Data"),
            enquiry.alias("Enq_Data"),
            user.alias("df_User"),
            F.col("accept_ind").alias("Accpt_Ind"),
        )
    carried = [n for n in ("file_name",) if n in scored.columns]
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return df.select(
        "request_id",
        *carried,
        text.alias("value"),
    )
