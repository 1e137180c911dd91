"""Request documents -> one typed row per request.

The report stays nested: a request is one document, so its accounts, histories
and enquiries travel with it and nothing has to be joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf, parse_date
from tradeline.functions.numbers import is_bad_number, to_amount, to_double, to_whole
from tradeline.operators.once import evaluated_once


def listed(text: Column) -> Column:
    """The elements of a field that was sent as a JSON list, else null."""
    return F.when(text.startswith("["), F.from_json(text, "array<string>"))


def header_at(name: str, i: Column) -> Column:
    """Row ``i`` of a header field: list element, or the scalar on every row.

    Reads ``header``, ``header_lists`` (parsed once per request) and ``header_rows``.
    """
    text = F.col("header")[name]
    return F.when(text.startswith("["), F.get(F.col("header_lists")[name], i)).when(
        i < F.col("header_rows"), text
    )


def phone_type(text: Column, normalise: bool = True) -> Column:
    """First element of a listed phone type, first letter of a plain one."""
    if not normalise:
        return text
    return F.when(text.startswith("["), F.get(listed(text), F.lit(0))).otherwise(
        F.nullif(F.substring(text, 1, 1), F.lit(""))
    )


def flat_features(bag: Column) -> Column:
    """Feature groups in document order as one ``array<struct<label, value>>``."""
    return F.flatten(F.map_values(bag))


def last_feature(features: Column, label: str) -> Column:
    """Value of the last entry with this label (later entries win)."""
    hits = F.filter(features, lambda e: e["label"] == label)
    return to_double(F.get(hits, F.array_size(hits) - 1)["value"])


def feature_map(features: Column) -> Column:
    """``map<label, double>``; a repeated label keeps its last value.

    Entries without a label are left out. They are sorted once and the last of each label stays, so the result does not depend on the
    session's duplicate-key policy.
    """
    entry = lambda e, i: F.struct(e["label"].alias("label"), i.alias("i"), e["value"].alias("value"))
    labelled = F.filter(features, lambda e: e["label"].isNotNull())
    ordered = F.array_sort(F.transform(labelled, entry))
    # By label and place: an entry is its label's last if the next one, laid beside it, has another label.
    following = F.slice(ordered, 2, F.array_size(ordered))
    own = F.zip_with(ordered, following, lambda e, n: F.when(n.isNull() | (n["label"] != e["label"]), e))
    last = F.filter(own, lambda e: e.isNotNull())
    by_place = F.array_sort(F.transform(last, lambda e: F.struct(e["i"].alias("i"), e["label"].alias("label"), e["value"].alias("value"))))
    return F.map_from_entries(
        F.transform(by_place, lambda e: F.struct(e["label"].alias("key"), to_double(e["value"]).alias("value")))
    )


def read_score(details: Column, missing: int) -> Column:
    """Score of the first entry; ``missing`` when no score block was sent."""
    return F.when(details.isNull(), F.lit(missing).cast("bigint")).otherwise(
        to_whole(F.get(details, F.lit(0))["Value"])
    )


def parse_requests(
    raw: DataFrame,
    cfg: PolicyConfig = CURRENT,
    detail: s.Detail = True,
    parts: Iterable[str] = s.REPORT_PARTS,
) -> DataFrame:
    """Parse ``value`` (one JSON document per row) into a typed request frame.

    ``raw`` needs ``request_id`` and ``value``; other columns are carried along.
    ``detail=False`` parses only what a decision reads, a collection the named parts in full;
    ``parts`` names the parts of the report that are parsed at all (the others are null). Undecodable
    documents stay in the frame with ``bad_json = true``. With ``cfg.key_presence`` the accounts are read
    a second time, as maps, and ``account_keys`` holds the keys that any account of the report has.
    """
    parts = tuple(parts)
    carried = [name for name in raw.columns if name != "value"]
    doc = F.from_json(
        "value",
        s.request_ddl(cfg.envelope, detail, parts),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": s.CORRUPT},
    )
    bureau = F.col("doc.bureau_data") if cfg.envelope else F.col("doc")
    bad_json = F.col("doc").isNull() | F.col(f"doc.{s.CORRUPT}").isNotNull()
    if cfg.envelope:
        envelope = [
            F.col("doc.user_id").alias("user_id"),
            flat_features(F.col("doc.ftpl_features")).alias("features"),
            F.col("doc.employment_details.min_monthly_income").alias("min_income"),
            F.col("doc.employment_details.max_monthly_income").alias("max_income"),
            (
                F.col("doc.user_id").isNull()
                | F.col("doc.ftpl_features").isNull()
                | F.col("doc.employment_details").isNull()
                | F.col("doc.bureau_data").isNull()
            ).alias("no_envelope"),
        ]
    else:
        envelope = [
            F.lit(None).cast("string").alias("user_id"),
            F.lit(None).cast("array<struct<label:string,value:string>>").alias("features"),
            F.lit(None).cast("string").alias("min_income"),
            F.lit(None).cast("string").alias("max_income"),
            F.lit(False).alias("no_envelope"),
        ]
    keys = []
    if cfg.key_presence:
        keys = [_account_keys(F.from_json("value", s.account_keys_ddl(cfg.envelope)), cfg.envelope).alias("account_keys")]
    inquiry = bureau["InquiryRequestInfo"]
    report = F.get(bureau["CCRResponse"]["CIRReportDataLst"], F.lit(0))
    # Two steps: the second one reads fields of the first, so the document is
    # parsed once per row and the first report is located once.
    located = raw.select(*carried, doc.alias("doc"), *keys).select(
        *carried,
        *(["account_keys"] if keys else []),
        bad_json.alias("bad_json"),
        *envelope,
        bureau["Error"].alias("top_error"),
        bureau["InquiryResponseHeader"].alias("header"),
        inquiry.alias("inquiry"),
        inquiry["InquiryPhones"].alias("phones"),
        report["Error"].alias("report_error"),
        report["CIRReportData"].alias("report"),
        report.isNull().alias("no_report"),
    )
    report = F.col("report")
    types = s.part_types(detail)

    def part(name: str) -> Column:
        return report[name] if name in parts else F.lit(None).cast(types[name])

    parsed = evaluated_once(
        located.select(
            *[c for c in located.columns if c != "report"],
            F.struct(*[listed(F.col(f"header.{f}")).alias(f) for f in s.HEADER_FIELDS]).alias("header_lists"),
            part("RetailAccountDetails").alias("raw_accounts"),
            part("EnquirySummary").alias("enquiry_summary"),
            part("Enquiries").alias("raw_enquiries"),
            part("ScoreDetails").alias("score_details"),
        )
    )
    sizes = [F.array_size(F.col(f"header_lists.{f}")) for f in s.HEADER_FIELDS]
    return parsed.withColumn("header_rows", F.coalesce(F.greatest(*sizes), F.lit(1)))


def _account_keys(doc: Column, envelope: bool) -> Column:
    """Distinct keys of all accounts of the first report."""
    bureau = doc["bureau_data"] if envelope else doc
    report = F.get(bureau["CCRResponse"]["CIRReportDataLst"], F.lit(0))["CIRReportData"]
    return F.array_distinct(F.flatten(F.transform(report["RetailAccountDetails"], F.map_keys)))


def report_number() -> Column:
    return header_at("ReportOrderNO", F.lit(0))


_ACCOUNT_DATES = {"opened": "DateOpened", "closed": "DateClosed", "reported": "DateReported"}


def typed_account(a: Column, ordinal: Column, as_of: AsOf, detail: bool) -> dict[str, Column]:
    """Typed fields of one raw account struct.

    Month codes become plain string arrays; with ``detail`` the raw account is
    kept for the account table. The three dates go through one parser and are
    named by the next stage, :func:`dated`.
    """
    month = a["History48Months"]
    spelled = F.array(*[a[name] for name in _ACCOUNT_DATES.values()])
    fields = {
        "ordinal": ordinal.cast("int"),
        "acct_number": a["AccountNumber"],
        "days": F.transform(spelled, lambda text: parse_date(text, as_of, day_first=True)),
        "balance": to_amount(a["Balance"]),
        "writeoff": to_amount(a["WriteOffAmount"]),
        "bad_number": is_bad_number(a["Balance"]) | is_bad_number(a["WriteOffAmount"]),
        "has_balance": a["Balance"].isNotNull(),
        "suit_status": a["SuitFiledStatus"],
        "payment": month["PaymentStatus"],
        "suit": month["SuitFiledStatus"],
        "asset": month["AssetClassificationStatus"],
    }
    if detail:
        fields["raw"] = a
    return fields


def dated(get: Callable[[str], Column], cfg: PolicyConfig, as_of: AsOf) -> dict[str, Column]:
    """Account dates by name."""
    return {name: F.get(get("days"), F.lit(i)) for i, name in enumerate(_ACCOUNT_DATES)}


def typed_enquiries(enquiries: Column, as_of: AsOf) -> Column:
    """Enquiry list with its parsed date (month-first when ambiguous)."""
    return F.transform(
        enquiries,
        lambda e: F.struct(
            e.alias("raw"), parse_date(e["Date"], as_of, day_first=False).alias("date")
        ),
    )
