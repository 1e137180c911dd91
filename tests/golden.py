"""Hand-written request documents. ``AS_OF`` is the decision date of every case."""

from __future__ import annotations

import copy
import datetime as dt
import json

AS_OF = dt.date(2024, 1, 31)
_ABSENT = object()
ABSENT = _ABSENT


def month(ago: int, day: int = 1) -> str:
    """ISO date ``ago`` calendar months before AS_OF."""
    n = AS_OF.year * 12 + AS_OF.month - 1 - ago
    return f"{n // 12:04d}-{n % 12 + 1:02d}-{day:02d}"


def cells(n: int = 48, payment: dict | None = None, suit: dict | None = None, asset: dict | None = None):
    """``n`` clean months; the dicts override single positions."""
    return [
        {
            "key": f"m{i}",
            "PaymentStatus": (payment or {}).get(i, "000"),
            "SuitFiledStatus": (suit or {}).get(i, "NS"),
            "AssetClassificationStatus": (asset or {}).get(i, "STD"),
        }
        for i in range(n)
    ]


def account(opened=month(24), reported=month(0), closed=ABSENT, balance="100", number="A1",
            history=None, **extra):
    out = {
        "AccountNumber": number, "Balance": balance, "DateOpened": opened, "DateReported": reported,
        "DateClosed": closed, "History48Months": cells() if history is None else history, **extra,
    }
    return {k: v for k, v in out.items() if v is not ABSENT}


def enquiries(*ago: int):
    return [{"seq": str(i), "Date": month(a), "Amount": "1"} for i, a in enumerate(ago)]


def request(accounts=None, score="750", enq=ABSENT, phones=None, limit_score=850, base=2000,
            income=(0, 10000), **patch):
    """A valid request; keyword arguments replace parts, ABSENT removes them."""
    report = {
        "RetailAccountDetails": [account()] if accounts is None else accounts,
        "ScoreDetails": ABSENT if score is ABSENT else [{"Value": score}],
        "EnquirySummary": {"Purpose": "ALL", "Total": "1", "Past30Days": "0", "Past12Months": "1",
                           "Past24Months": "1", "Recent": "x"},
        "Enquiries": enq,
    }
    report = {k: v for k, v in report.items() if v is not ABSENT}
    doc = {
        "user_id": "u1",
        "ftpl_features": {
            "g1": [{"label": "offline_bnpl_score", "value": limit_score},
                   {"label": "offline_bnpl_limit", "value": base}],
        },
        "employment_details": {"min_monthly_income": income[0], "max_monthly_income": income[1]},
        "bureau_data": {
            "InquiryResponseHeader": {
                "ClientID": "c1", "CustRefField": "ref", "ReportOrderNO": "R1",
                "ProductCode": ["P"], "SuccessCode": "1", "Date": "2024-01-31", "Time": "10:00:00",
            },
            "InquiryRequestInfo": {
                "InquiryPurpose": "ip", "FirstName": "fn",
                "InquiryPhones": phones or [{"seq": "1", "PhoneType": ["M"], "Number": "555"}],
            },
            "CCRResponse": {"CIRReportDataLst": [{"CIRReportData": report}]},
        },
    }
    doc = copy.deepcopy(doc)
    for path, value in patch.items():
        node = doc
        *parents, last = path.split("__")
        for p in parents:
            node = node[int(p) if p.isdigit() else p]
        if value is ABSENT:
            node.pop(last)
        else:
            node[last] = value
    return json.dumps(doc)
