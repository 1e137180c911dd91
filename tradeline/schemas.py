"""Input document schema and the fixed column lists of the output tables.

Every scalar of the bureau report is read as text: feeds mix strings, numbers
and one-element lists, and a list read as text keeps its JSON spelling.
"""

from __future__ import annotations

from collections.abc import Collection

CORRUPT = "_corrupt_record"

HEADER_FIELDS = ("ClientID", "CustRefField", "ReportOrderNO", "ProductCode", "SuccessCode", "Date", "Time")
INQUIRY_FIELDS = ("InquiryPurpose", "FirstName", "LastName", "CustomFields")
PHONE_FIELDS = ("seq", "PhoneType", "Number")
SUMMARY_FIELDS = ("Purpose", "Total", "Past30Days", "Past12Months", "Past24Months", "Recent")
ENQUIRY_FIELDS = ("seq", "Institution", "Date", "Time", "RequestPurpose", "Amount")
HISTORY_FIELDS = ("key", "PaymentStatus", "SuitFiledStatus", "AssetClassificationStatus")
ACCOUNT_FIELDS = (
    "seq", "AccountNumber", "Institution", "AccountType", "OwnershipType", "Balance",
    "PastDueAmount", "Open", "HighCredit", "LastPaymentDate", "CreditLimit", "AccountStatus",
    "source", "LastPayment", "SanctionAmount", "RepaymentTenure", "TermFrequency",
    "InstallmentAmount", "Reason", "AssetClassification", "InterestRate", "WriteOffAmount",
    "SuitFiledStatus", "DateOpened", "DateClosed", "DateReported", "CollateralType",
    "CollateralValue",
)

# What the decision alone needs. JSON parsing skips every other key.
DECISION_ACCOUNT = (
    "AccountNumber", "Balance", "WriteOffAmount", "SuitFiledStatus", "DateOpened", "DateClosed",
    "DateReported",
)
DECISION_HISTORY = HISTORY_FIELDS[1:]


def _struct(fields, *typed: str) -> str:
    return "struct<" + ", ".join([f"`{f}`: string" for f in fields] + list(typed)) + ">"


# The parts of a report that parsing can leave out.
REPORT_PARTS = ("RetailAccountDetails", "ScoreDetails", "EnquirySummary", "Enquiries")


#: True: all fields of a report; False: those a decision reads; names of parts: these parts with all fields.
Detail = bool | Collection[str]


def in_full(detail: Detail, part: str) -> bool:
    return detail if isinstance(detail, bool) else part in detail


def part_types(detail: Detail = True) -> dict[str, str]:
    """DDL type of each part of the report."""
    accounts_in_full = in_full(detail, "RetailAccountDetails")
    history = _struct(HISTORY_FIELDS if accounts_in_full else DECISION_HISTORY)
    account = _struct(
        ACCOUNT_FIELDS if accounts_in_full else DECISION_ACCOUNT, f"History48Months: array<{history}>"
    )
    return {
        "RetailAccountDetails": f"array<{account}>",
        "ScoreDetails": f"array<{_struct(('Value',))}>",
        "EnquirySummary": _struct(SUMMARY_FIELDS),
        "Enquiries": f"array<{_struct(ENQUIRY_FIELDS if in_full(detail, 'Enquiries') else ('Date',))}>",
    }


def bureau_type(detail: Detail = True, parts: tuple[str, ...] = REPORT_PARTS) -> str:
    """DDL type of the bureau report; ``detail=False`` keeps decision inputs only."""
    types = part_types(detail)
    detail = in_full(detail, "InquiryRequestInfo")
    phones = _struct(PHONE_FIELDS if detail else ("Number",))
    error = _struct(("ErrorCode", "ErrorDesc"))
    # A report without any part is still told from a missing one.
    report = "struct<" + ", ".join(f"{n}: {types[n]}" for n in parts or REPORT_PARTS[1:2]) + ">"
    return (
        f"struct<Error: {error}, "
        f"InquiryResponseHeader: {_struct(HEADER_FIELDS)}, "
        "InquiryRequestInfo: "
        f"{_struct(INQUIRY_FIELDS if detail else (), f'InquiryPhones: array<{phones}>')}, "
        "CCRResponse: struct<CIRReportDataLst: "
        f"array<struct<Error: {error}, CIRReportData: {report}>>>>"
    )


def request_ddl(
    envelope: bool = True, detail: Detail = True, parts: tuple[str, ...] = REPORT_PARTS
) -> str:
    """DDL of one input document, with the corrupt-record column."""
    bureau = bureau_type(detail, parts)
    if not envelope:
        return f"{bureau[:-1]}, {CORRUPT}: string>"
    return (
        "user_id string, "
        "ftpl_features map<string, array<struct<label: string, value: string>>>, "
        "employment_details struct<min_monthly_income: string, max_monthly_income: string>, "
        f"bureau_data {bureau}, {CORRUPT} string"
    )


def account_keys_ddl(envelope: bool = True) -> str:
    """DDL that reads the accounts of a report as maps, which tell an absent key from a null one."""
    report = "struct<RetailAccountDetails: array<map<string, string>>>"
    bureau = f"struct<CCRResponse: struct<CIRReportDataLst: array<struct<CIRReportData: {report}>>>>"
    return f"bureau_data {bureau}" if envelope else bureau


# Rolled-up metrics and rule outcomes: the 26 columns of the user policy table.
METRIC_FIELDS = (
    ("sum_perf_avail", "bigint"),
    ("cnt_derog_accts", "bigint"),
    ("cnt_overdue_accts", "bigint"),
    ("cnt_dpd90_l12m_accts", "bigint"),
    ("cnt_dpd60_l12m_accts", "bigint"),
    ("cnt_dpd30_l6m_accts", "bigint"),
    ("cnt_dpd30_l12m_accts", "bigint"),
    ("sum_dpd_ins_l12m", "bigint"),
    ("sum_dpd_ins_l6m", "bigint"),
    ("sum_dpd_ins_l3m", "bigint"),
    ("max_inq_l3m", "bigint"),
    ("max_score", "boolean"),
    ("cnt_accts", "bigint"),
)
RULE_NAMES = (
    "sum_perf_avail_dec", "cnt_derog_accts_dec", "cnt_overdue_accts_dec",
    "cnt_dpd90_l12m_accts_dec", "cnt_dpd60_l12m_accts_dec", "cnt_dpd30_l6m_accts_dec",
    "cnt_dpd30_l12m_accts_rt_dec", "sum_dpd_ins_l12m_dec", "sum_dpd_ins_l6m_dec",
    "sum_dpd_ins_l3m_dec", "max_inq_l3m_dec", "max_score_dec",
)
USER_POLICY_FIELDS = (
    ("reportnumber", "string"), *METRIC_FIELDS, *((name, "boolean") for name in RULE_NAMES),
)

ENQUIRY_OUT_FIELDS = (
    ("seq", "string"), ("institution", "string"), ("date", "string"), ("time", "string"),
    ("requestpurpose", "string"), ("amount", "string"), ("date_n", "timestamp_ntz"),
    ("inq_flag", "boolean"),
)

# Columns that hold dates. They are timestamps in tables and text in documents.
DATE_COLUMNS = frozenset(("dateopened_n", "dateclosed_n", "datereported_n", "date_n"))

# The columns of the account table with their types, in output
# order, as the launch profile spells them. The conformed table has them in
# lower case. Each series of months is written as name, first and last number.
_ACCOUNT_TABLE = """
CLIENT_ID string, REFERENCE_NO string, {user} string, REPORTNUMBER string, ProductCode string,
SuccessCode string, Date string, Time string, InquiryPurpose string, FirstName string, seq string,
PhoneType string, Number string, Input_Detail_Type string, ErrorCode string, ErrorDesc string,
Bur_Hist_Sta string, ACCT_NUMBER string, Institution string, ACCOUNTTYPE string,
OWNERSHIPTYPE string, BALANCE double, PASTDUEAMOUNT string, Open string, HIGHCREDIT string,
LASTPAYMENTDATE string, CREDITLIMIT string, ACCOUNTSTATUS string, source string,
LASTPAYMENT string, SANCTIONAMOUNT string, REPAYMENTTENURE string, TERMFREQUENCY string,
INSTALLMENTAMOUNT string, Reason string, ASSETCLASSIFICATION string, key_0..48 string,
INTERESTRATE string, WRITEOFFAMOUNT double, SUITFILEDSTATUS string, DAYS_PAST_DUE int,
ACCT_UNIQ_ID int, ACCT_ST_49 string, SUIT_FILED_ST_49 string, ASSET_CL_ST_49 string,
DATEOPENED_N timestamp_ntz, Acct_MOB int, Score bigint, Purpose string, Total string,
Past30Days string, Past12Months string, Past24Months string, DATECLOSED_N timestamp_ntz,
DATEREPORTED_N timestamp_ntz, Tenure_Clo_Ope int, Tenure_Rep_Ope int, Tenure_Avai int,
Non_Avail_Per int, SuitSt_L0..48M int, AcctSt_L0..48M int, AssetSt_L0..48M int,
Perf_Avail boolean, Derog_Pol boolean, Act_Acct_Pol boolean, DPD90_Pol_L12M boolean,
DPD60_Pol_L12M boolean, DPD30_Pol_L6M boolean, DPD30_Pol_L12M boolean, DPD30_Pol_l12m_cnt int,
DPD30_Pol_l6m_cnt int, DPD30_Pol_l3m_cnt int, Sco_Pol boolean, INQ_Flag bigint, Recent string,
CollateralType string, CollateralValue string, LastName string, CustomFields string
"""

# The launch profile's spelling of the user table's columns.
_LAUNCH_USER = (
    "Sum_Perf_Avail", "Cnt_Derog_Accts", "Cnt_OverDue_Accts", "Cnt_DPD90_L12M_Accts",
    "Cnt_DPD60_L12M_Accts", "Cnt_DPD30_L6M_Accts", "Cnt_DPD30_L12M_Accts", "Sum_DPD_Ins_L12M",
    "Sum_DPD_Ins_L6M", "Sum_DPD_Ins_L3M", "Max_Inq_L3M", "Max_Score", "Cnt_Accts",
    "Sum_Perf_Avail_Dec", "Cnt_Derog_Accts_Dec", "Cnt_OverDue_Accts_Dec",
    "Cnt_DPD90_L12M_Accts_Dec", "Cnt_DPD60_L12M_Accts_Dec", "Cnt_DPD30_L6M_Accts_Dec",
    "Cnt_DPD30_L12M_Accts_Rt_Dec", "Sum_DPD_Ins_L12M_Dec", "Sum_DPD_Ins_L6M_Dec",
    "Sum_DPD_Ins_L3M_Dec", "Max_Inq_L3M_Dec", "Max_Score_Dec",
)


def _spelled_bureau_fields(user_column: str) -> list[tuple[str, str]]:
    out = []
    for field in _ACCOUNT_TABLE.format(user=user_column).split(","):
        name, kind = field.split()
        if ".." in name:
            stem, last = name.split("0..48")
            out += [(f"{stem}{i}{last}", kind) for i in range(49)]
        else:
            out.append((name, kind))
    return out


def bureau_fields(user_column: str = "user_id") -> tuple[tuple[str, str], ...]:
    """The 271 columns of the account table, in output order."""
    return tuple((name.lower(), kind) for name, kind in _spelled_bureau_fields(user_column))


def launch_names(user_column: str = "user_id") -> dict[str, str]:
    """Lower-case column name -> spelling in the launch profile's documents."""
    enquiry = (*ENQUIRY_FIELDS, "Date_N", "INQ_Flag")
    out = {name.lower(): name for name in enquiry}
    out.update({name.lower(): name for name, _ in _spelled_bureau_fields(user_column)})
    out.update({name.lower(): name for name in _LAUNCH_USER})
    return out


DECISION_FIELDS = (
    ("request_id", "string"), ("user_id", "string"), ("accept_ind", "string"),
    ("bureau_history_status", "string"), ("bnpl_limit", "bigint"), ("error_reason", "string"),
)
