"""A slow, plain-Python reading of the policy for one document, and random documents.

Months are absolute numbers here (year * 12 + month) and every history becomes a
``{month: code}`` dict, unlike the array frames of the engine.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import random
import re

from tests.golden import AS_OF, month
from bridge.expected import (
    ASSET_CODES, INCOME_BRACKETS, LIMIT_CEILING, LIMIT_FLOOR, LIMIT_MULTIPLIER, PAYMENT_CODES,
    SCORE_BANDS, SUIT_CODES,
)

NOW = AS_OF.year * 12 + AS_OF.month


class Bad(Exception):
    pass


def _month(text):
    if not isinstance(text, str):
        return None
    try:
        day = dt.date.fromisoformat(text)
    except ValueError:
        return None
    return day.year * 12 + day.month


def _number(value):
    if value is None:
        return None
    try:
        number = float(value)
    except ValueError as e:
        raise Bad("BAD_NUMBER") from e
    return None if math.isnan(number) else number


def _limit(doc):
    bag = {}
    for group in doc["ftpl_features"].values():
        for entry in group:
            bag[entry["label"]] = float(entry["value"])
    score, base = bag.get("offline_bnpl_score"), bag.get("offline_bnpl_limit")
    if score is None or base is None or math.isnan(base):
        raise Bad("BAD_LIMIT_INPUT")
    band = next((b for b, bound in SCORE_BANDS if score >= bound), "G")
    job = doc["employment_details"]
    pair = (job.get("min_monthly_income"), job.get("max_monthly_income"))
    column = {(lo, hi): i for lo, hi, i in INCOME_BRACKETS}.get(pair, 1) - 1
    amount = min(base * LIMIT_MULTIPLIER[band][column], LIMIT_CEILING[band][column])
    return math.ceil(max(amount, LIMIT_FLOOR[band][column]) / 100) * 100


def _judge(report, header):
    """(accept, thin) of a report with accounts."""
    accounts = report["RetailAccountDetails"]
    histories = [a.get("History48Months") or [] for a in accounts]
    first = [h[0] for h in histories if h]
    has_status = any(a.get("SuitFiledStatus") is not None for a in accounts)
    has_suit = any(c.get("SuitFiledStatus") is not None for c in first)
    if not any(c.get("PaymentStatus") is not None for c in first) or not (has_status or has_suit):
        raise Bad("MISSING_HISTORY")
    details = report.get("ScoreDetails")
    score = 99999
    if details is not None:
        value = str(details[0].get("Value"))
        if not re.fullmatch(r"[+-]?\d+", value):
            raise Bad("BAD_NUMBER")
        score = int(value)
    if all(a.get("Balance") is None for a in accounts):
        raise Bad("MISSING_FIELD")
    amounts = [(_number(a.get("Balance")), _number(a.get("WriteOffAmount"))) for a in accounts]

    rows = []
    for a, h, (balance, writeoff) in zip(accounts, histories, amounts):
        rows.append({
            "opened": _month(a.get("DateOpened")), "closed": _month(a.get("DateClosed")),
            "reported": _month(a.get("DateReported")), "balance": balance, "writeoff": writeoff,
            "history": h, "number": a.get("AccountNumber"),
        })
    mobs = [NOW - r["opened"] for r in rows if r["opened"] is not None]
    products = header.get("ProductCode")
    repeats = max(len(products) if isinstance(products, list) else 1, header["phones"], 1)
    thin = (not mobs or max(mobs) < 6) and len(rows) * repeats <= 1

    rows = [r for r in rows if r["opened"] is not None]
    if any(r["closed"] is None and r["reported"] is None for r in rows):
        raise Bad("NULL_TENURE")
    lags = [NOW - r["reported"] for r in rows if r["reported"] is not None]
    if len(lags) < len(rows) and any(lag <= 48 for lag in lags):
        raise Bad("NULL_REPORT_DATE")
    if any(-48 <= lag < 0 for lag in lags):
        raise Bad("FUTURE_REPORT_DATE")
    rows = [r for r in rows if r["reported"] is not None]
    if not rows:
        return "0", thin
    if all(a.get("AccountNumber") is None for a in accounts):
        raise Bad("MISSING_FIELD")
    if header.get("ReportOrderNO") is None:
        raise Bad("NULL_REPORT_NUMBER")

    total = dict.fromkeys(("seen", "derog", "due", "d90", "d60", "d30_6", "d30", "n12", "n6", "n3", "accts"), 0)
    for r in rows:
        lag = NOW - r["reported"]
        top = NOW if lag < 0 else r["reported"]
        months = {}
        if lag <= 48:
            for i, cell in enumerate(r["history"][:48]):
                if NOW - (top - i) <= 47:
                    months[NOW - (top - i)] = cell
        def level(cell, name, table):
            return table.get(cell.get(name))
        pay = {k: v for k, c in months.items() if (v := level(c, "PaymentStatus", PAYMENT_CODES)) is not None}
        late = lambda upto, floor: [k for k, v in pay.items() if 1 <= k <= upto and v >= floor]
        assets = [level(c, "AssetClassificationStatus", ASSET_CODES) or -99 for c in months.values()]
        suits = [level(c, "SuitFiledStatus", SUIT_CODES) or -99 for c in months.values()]
        now = PAYMENT_CODES.get(r["history"][0].get("PaymentStatus")) if r["history"] else None
        total["seen"] += lag <= 48
        total["derog"] += (
            (NOW - r["opened"] <= 48 and (r["writeoff"] or 0) > 0)
            or any(v >= 5 for v in pay.values()) or any(v >= 4 for v in assets) or any(v >= 0 for v in suits)
        )
        total["due"] += (r["balance"] or 0) > 0 and (now or 0) > 0
        total["d90"] += bool(late(12, 4))
        total["d60"] += bool(late(12, 3))
        total["d30_6"] += bool(late(6, 2))
        total["d30"] += bool(late(12, 2))
        total["n12"] += len(late(12, 2))
        total["n6"] += len(late(6, 2))
        total["n3"] += len(late(3, 2))
        total["accts"] += r["number"] is not None
    recent = 0
    for e in report.get("Enquiries") or []:
        m = _month(e.get("Date"))
        recent += m is not None and NOW - m <= 3
    good = (
        total["seen"] > 0 and total["derog"] == 0 and total["due"] <= 1 and total["d90"] <= 0
        and total["d60"] <= 1 and total["d30_6"] <= 1
        and total["accts"] > 0 and total["d30"] / total["accts"] <= 0.33
        and total["n12"] <= 5 and total["n6"] <= 3 and total["n3"] <= 0 and recent <= 10 and score >= 700
    )
    return str(good), thin


def decide(text):
    """(accept, status, limit, error)."""
    try:
        try:
            doc = json.loads(text)
        except ValueError as e:
            raise Bad("BAD_JSON") from e
        if any(doc.get(k) is None for k in ("user_id", "ftpl_features", "employment_details", "bureau_data")):
            raise Bad("MISSING_ENVELOPE")
        for group in doc["ftpl_features"].values():
            for entry in group:
                try:
                    float(entry["value"])
                except (TypeError, ValueError) as e:
                    raise Bad("BAD_NUMBER") from e
        bureau = doc["bureau_data"]
        head, inquiry = bureau.get("InquiryResponseHeader"), bureau.get("InquiryRequestInfo")
        if head is None or inquiry is None or inquiry.get("InquiryPhones") is None:
            raise Bad("MISSING_HEADER")
        if bureau.get("Error") is not None:
            return None, "NA", _limit(doc), None
        parts = (bureau.get("CCRResponse") or {}).get("CIRReportDataLst") or []
        if not parts:
            raise Bad("MISSING_REPORT")
        if parts[0].get("Error") is not None:
            return "True", "NTC", _limit(doc), None
        report = parts[0].get("CIRReportData")
        if report is None or report.get("RetailAccountDetails") is None:
            raise Bad("MISSING_REPORT")
        accept, thin = _judge(report, {**head, "phones": len(inquiry["InquiryPhones"])})
        return accept, "NTC" if thin else "ETC", _limit(doc), None
    except Bad as e:
        return None, None, None, str(e)


def random_document(rng: random.Random) -> str:
    """A document in which any part may be odd, late or missing."""

    def maybe(value, gone=0.06):
        return None if rng.random() < gone else value

    calm = rng.random() < 0.7
    pay_codes = ["000", "STD", "*", "ZZZ", None] + ([] if calm else list(PAYMENT_CODES))
    suit_codes = ["NS", "*", None] + ([] if calm else list(SUIT_CODES))
    asset_codes = ["STD", "SUB", "DBT", None] + ([] if calm else list(ASSET_CODES))
    gone = 0.0 if rng.random() < 0.6 else 0.15

    def drop(d):
        return {k: v for k, v in d.items() if v is not None}

    def account():
        size = rng.choice([0, 1, 3, 12, 30, 48, 50])
        cells = [
            drop({"PaymentStatus": rng.choice(pay_codes), "SuitFiledStatus": rng.choice(suit_codes),
                  "AssetClassificationStatus": rng.choice(asset_codes)})
            for _ in range(size)
        ]
        if cells and rng.random() < 0.9:
            cells[0].setdefault("PaymentStatus", "000")
            cells[0].setdefault("SuitFiledStatus", "NS")
        if calm and size > 9 and rng.random() < 0.3:
            cells[rng.randrange(size)]["PaymentStatus"] = rng.choice(["01+", "30+", "60+", "90+"])
        lag = rng.choice([0, 0, 0, 1, 2, 5, 11, 12, 13, 30, 47, 48, 49, 60] + ([] if calm else [-1, -48, -49, -70]))
        return drop({
            "AccountNumber": maybe("A1", gone), "Balance": maybe(rng.choice(["0", "10", 20.5, "nan"]), gone)
            if rng.random() > gone / 4 else "x1",
            "WriteOffAmount": rng.choice([None, None, None, None, "0", "7"]),
            "SuitFiledStatus": rng.choice([None, None, "NS"]),
            "DateOpened": maybe(rng.choice([month(rng.choice([0, 3, 5, 6, 20, 47, 48, 49, 80]), rng.randint(1, 28)), "??"]), gone),
            "DateReported": maybe(month(lag, rng.randint(1, 28)), gone),
            "DateClosed": maybe(month(rng.randint(0, 40)), 0.5), "History48Months": maybe(cells, gone),
        })

    report = drop({
        "RetailAccountDetails": maybe([account() for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5]))], gone / 3),
        "ScoreDetails": maybe([{"Value": rng.choice(["700", "699", 850, "750", "n/a" if gone else "701"])}], 0.2),
        "Enquiries": maybe([drop({"Date": maybe(month(rng.choice([-1, 0, 3, 4, 9])))}) for _ in range(rng.choice([0, 2, 9, 14]))], 0.3),
    })
    error = {"ErrorCode": "1", "ErrorDesc": "d"}
    features = {
        "a": [{"label": "offline_bnpl_score", "value": rng.choice([0, "399.5", 500, "900", "nan"])}] if rng.random() > gone / 3 else [],
        "b": [{"label": "offline_bnpl_limit", "value": rng.choice([0, 100, "999.5", 5000, "nan" if gone else 7])},
              {"label": "z", "value": "oops" if rng.random() < gone / 5 else 1}],
        "c": [{"label": "offline_bnpl_score", "value": 810}] if rng.random() < 0.2 else [],
    }
    low, high = rng.choice([(lo, hi) for lo, hi, _ in INCOME_BRACKETS] + [(1, 2), (50000, 60000), (None, None)])
    bureau = drop({
        "Error": error if rng.random() < 0.05 else None,
        "InquiryResponseHeader": maybe(drop({
            "ReportOrderNO": maybe("R", gone), "ProductCode": rng.choice([["P"], ["P"], "P", ["P", "Q"]]),
        }), gone / 4),
        "InquiryRequestInfo": maybe({"InquiryPhones": [{"Number": "1"}] * rng.choice([1, 1, 1, 2])}, gone / 4),
        "CCRResponse": maybe({"CIRReportDataLst": [drop({
            "Error": error if rng.random() < 0.05 else None, "CIRReportData": maybe(report, gone / 4)})]}, gone / 4),
    })
    doc = drop({
        "user_id": maybe("u", gone / 6), "ftpl_features": maybe(features, gone / 6),
        "employment_details": maybe(drop({"min_monthly_income": low, "max_monthly_income": high}), gone / 6),
        "bureau_data": maybe(bureau, gone / 6),
    })
    text = json.dumps(doc)
    return text[: rng.randrange(1, len(text))] if rng.random() < gone / 8 else text
