"""Parsed requests as flat tables: one row per account, month, phone, header row or enquiry.

Exploding keeps the request's own columns beside each row, so nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.functions import history as h
from tradeline.functions.dates import AsOf
from tradeline.operators import parse

#: Account fields that get another name in the output tables.
ACCOUNT_NAMES = {
    "AccountNumber": "acct_number", "AccountStatus": "accountstatus", "AccountType": "accounttype",
    "AssetClassification": "assetclassification", "Balance": "balance",
    "InstallmentAmount": "installmentamount", "LastPayment": "lastpayment",
    "LastPaymentDate": "lastpaymentdate", "OwnershipType": "ownershiptype",
    "PastDueAmount": "pastdueamount", "RepaymentTenure": "repaymenttenure",
    "TermFrequency": "termfrequency", "HighCredit": "highcredit", "CreditLimit": "creditlimit",
    "SanctionAmount": "sanctionamount", "InterestRate": "interestrate",
    "WriteOffAmount": "writeoffamount", "SuitFiledStatus": "suitfiledstatus",
}

#: Month series of the wide history: column stem, field of a month.
WIDE_SERIES = (
    ("acct_st", "PaymentStatus"), ("suit_filed_st", "SuitFiledStatus"),
    ("asset_cl_st", "AssetClassificationStatus"),
)


def accounts(parsed: DataFrame, *columns: str) -> DataFrame:
    """request_id, ``columns``, ordinal, a (the raw account)."""
    return parsed.select("request_id", *columns, F.posexplode("raw_accounts").alias("ordinal", "a"))


def months(rows: DataFrame) -> DataFrame:
    """request_id, ordinal, i, h (one month) of the histories of ``accounts`` rows."""
    return rows.select("request_id", "ordinal", F.posexplode("a.History48Months").alias("i", "h"))


def wide_history(account: Column) -> list[Column]:
    """The 49 first months of each series, a column for each."""
    return [
        F.get(account["History48Months"][field], F.lit(i)).alias(f"{stem}_{i + 1}")
        for stem, field in WIDE_SERIES
        for i in range(h.GRID)
    ]


def renamed(account: Column) -> list[Column]:
    """Account fields under their output names."""
    return [account[raw].alias(name) for raw, name in ACCOUNT_NAMES.items()]


def summary() -> list[Column]:
    """The enquiry summary of a request under its output names."""
    return [F.col("enquiry_summary")[f].alias(f.lower()) for f in s.SUMMARY_FIELDS]


def phones(parsed: DataFrame, normalise: bool = True) -> DataFrame:
    """request_id, i, phonetype, number."""
    rows = parsed.select("request_id", F.posexplode("phones").alias("i", "p"))
    kind = parse.phone_type(F.col("p.PhoneType"), normalise)
    return rows.select("request_id", "i", kind.alias("phonetype"), F.col("p.Number").alias("number"))


def header_rows(parsed: DataFrame) -> DataFrame:
    """request_id, i, productcode, number: products and phones side by side, by position."""
    products, numbers = F.col("header_lists.ProductCode"), F.col("phones.Number")
    zipped = F.arrays_zip(products.alias("productcode"), numbers.alias("number"))
    rows = parsed.select(
        "request_id", F.posexplode(F.when(F.col("header").isNotNull(), zipped)).alias("i", "z")
    )
    return rows.select("request_id", "i", "z.productcode", "z.number")


def enquiries(parsed: DataFrame, as_of: AsOf) -> DataFrame:
    """request_id, raw, date."""
    typed = parse.typed_enquiries(F.col("raw_enquiries"), as_of)
    return parsed.select("request_id", F.explode(typed).alias("e")).select("request_id", "e.*")
