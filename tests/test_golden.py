"""One hand-written document per routing branch, rule edge and record error."""

import dataclasses

import pytest

from tests.golden import ABSENT, AS_OF, account, cells, enquiries, month, request
from tradeline import CURRENT, LAUNCH, decide_documents, parse_requests, score_requests

REPORT = "bureau_data__CCRResponse__CIRReportDataLst__0"
ERR = {"ErrorCode": "E1", "ErrorDesc": "none"}
fresh = lambda **kw: account(opened=month(3), **kw)

# id -> (document, accept, status, limit, error); limit 800 is the default case.
CASES = {
    "g01 invalid input": (request(bureau_data__Error=ERR), None, "NA", 800, None),
    "g02 no hit": (request(**{f"{REPORT}__Error": ERR}), "True", "NTC", 800, None),
    "g03 thin clean": (request([fresh()]), "True", "NTC", 800, None),
    "g04 thin late": (request([fresh(history=cells(payment={2: "30+"}))]), "False", "NTC", 800, None),
    "g05 one undated": (request([account(opened=ABSENT)]), "0", "NTC", 800, None),
    "g06 two undated": (request([account(opened=ABSENT)] * 2), "0", "ETC", 800, None),
    "g07 two phones": (
        request([fresh()], phones=[{"seq": "1", "Number": "1"}, {"seq": "2", "Number": "2"}]),
        "True", "ETC", 800, None),
    "g07b two products": (
        request([fresh()], bureau_data__InquiryResponseHeader__ProductCode=["A", "B"]),
        "True", "ETC", 800, None),
    "g08 lag 48": (request([account(reported=month(48))]), "True", "ETC", 800, None),
    "g09 lag 49": (request([account(reported=month(49))]), "False", "ETC", 800, None),
    "g10 SUB at L40": (request([account(history=cells(payment={40: "SUB"}))]), "False", "ETC", 800, None),
    "g11 LOSS payment": (request([account(history=cells(payment={5: "LOSS"}))]), "True", "ETC", 800, None),
    "g11 LOSS asset": (request([account(history=cells(asset={5: "LOSS"}))]), "False", "ETC", 800, None),
    "g12 DBT asset": (request([account(history=cells(asset={5: "DBT"}))]), "True", "ETC", 800, None),
    "g13 SF": (request([account(history=cells(suit={5: "SF"}))]), "False", "ETC", 800, None),
    "g13 star": (request([account(history=cells(suit={5: "*"}))]), "True", "ETC", 800, None),
    "g14 L0 only": (request([account(balance="0", history=cells(payment={0: "30+"}))]), "True", "ETC", 800, None),
    "g15 ratio third": (
        request([account(), account(), account(history=cells(payment={8: "30+"}))]),
        "False", "ETC", 800, None),
    "g16 ratio quarter": (
        request([account()] * 3 + [account(history=cells(payment={8: "30+"}))]),
        "True", "ETC", 800, None),
    "g17 ten enquiries": (request(enq=enquiries(*[3] * 10, 4)), "True", "ETC", 800, None),
    "g17 eleven": (request(enq=enquiries(*[3] * 10, -2)), "False", "ETC", 800, None),
    "g18 no score": (request(score=ABSENT), "True", "ETC", 800, None),
    "g18 700": (request(score="700"), "True", "ETC", 800, None),
    "g18 699": (request(score=699), "False", "ETC", 800, None),
    "g19 write-off 48": (request([account(opened=month(48), WriteOffAmount="5")]), "False", "ETC", 800, None),
    "g19 write-off 49": (request([account(opened=month(49), WriteOffAmount="5")]), "True", "ETC", 800, None),
    "g20 cap": (request(), "True", "ETC", 800, None),
    "g21 floor": (request(limit_score=300, income=(50000, None), base=100), "True", "ETC", 300, None),
    "g22 round": (request(limit_score=950, income=(50000, None), base=1234), "True", "ETC", 1900, None),
    "g23 odd bracket": (request(limit_score=950, income=(5000, 9000), base=900), "True", "ETC", 1000, None),
    "g25 label twice": (
        request(ftpl_features__g2=[{"label": "offline_bnpl_score", "value": "100"}]),
        "True", "ETC", 500, None),
    "overdue one": (request([account(history=cells(payment={0: "01+"}))]), "True", "ETC", 800, None),
    "overdue two": (request([account(history=cells(payment={0: "01+"}))] * 2), "False", "ETC", 800, None),
    "all unreported": (
        request([account(reported=ABSENT, closed=month(5))]), "0", "ETC", 800, None),
    "unreported beside old": (
        request([account(reported=ABSENT, closed=month(5)), account(reported=month(60))]),
        "False", "ETC", 800, None),
    "reported five years ahead": (request([account(reported=month(-60))]), "True", "ETC", 800, None),
    "nan balance": (
        request([account(balance="nan", history=cells(payment={0: "60+"}))] * 2), "True", "ETC", 800, None),
    "year 9999 close": (request([account(closed="9999-12-31")]), "True", "ETC", 800, None),
    "short history": (request([account(history=cells(3))]), "True", "ETC", 800, None),
    "number for text": (request([account(balance=12.5)], score=750), "True", "ETC", 800, None),
    # record errors
    "broken json": (request()[:-9], None, None, None, "BAD_JSON"),
    "empty text": ("", None, None, None, "BAD_JSON"),
    "json list": ("[1]", None, None, None, "BAD_JSON"),
    "no user": (request(user_id=ABSENT), None, None, None, "MISSING_ENVELOPE"),
    "no features": (request(ftpl_features=ABSENT), None, None, None, "MISSING_ENVELOPE"),
    "no employment": (request(employment_details=ABSENT), None, None, None, "MISSING_ENVELOPE"),
    "no bureau": (request(bureau_data=ABSENT), None, None, None, "MISSING_ENVELOPE"),
    "no header": (request(bureau_data__InquiryResponseHeader=ABSENT), None, None, None, "MISSING_HEADER"),
    "no inquiry": (request(bureau_data__InquiryRequestInfo=ABSENT), None, None, None, "MISSING_HEADER"),
    "no phones": (
        request(bureau_data__InquiryRequestInfo__InquiryPhones=ABSENT), None, None, None, "MISSING_HEADER"),
    "invalid without header": (
        request(bureau_data__Error=ERR, bureau_data__InquiryResponseHeader=ABSENT),
        None, None, None, "MISSING_HEADER"),
    "no report": (request(bureau_data__CCRResponse=ABSENT), None, None, None, "MISSING_REPORT"),
    "no accounts key": (
        request(**{f"{REPORT}__CIRReportData__RetailAccountDetails": ABSENT}),
        None, None, None, "MISSING_REPORT"),
    "no account": (request([]), None, None, None, "MISSING_HISTORY"),
    "no history": (request([account(history=[])]), None, None, None, "MISSING_HISTORY"),
    "no suit at month 0": (
        request([account(history=[{"PaymentStatus": "000"}])]), None, None, None, "MISSING_HISTORY"),
    "suit on account": (
        request([account(history=[{"PaymentStatus": "000"}], SuitFiledStatus="NS")]),
        "True", "ETC", 800, None),
    "no balance": (request([account(balance=ABSENT)]), None, None, None, "MISSING_FIELD"),
    "no number": (request([account(number=ABSENT)]), None, None, None, "MISSING_FIELD"),
    "bad balance": (request([account(balance="abc")]), None, None, None, "BAD_NUMBER"),
    "bad balance undated": (
        request([account(), account(balance="1f", opened=ABSENT)]), None, None, None, "BAD_NUMBER"),
    "bad write-off": (request([account(WriteOffAmount="")]), None, None, None, "BAD_NUMBER"),
    "bad score": (request(score="7xx"), None, None, None, "BAD_NUMBER"),
    "bad feature": (
        request(ftpl_features__g2=[{"label": "x", "value": "y"}]), None, None, None, "BAD_NUMBER"),
    "no tenure": (request([account(reported=ABSENT)]), None, None, None, "NULL_TENURE"),
    "some unreported": (
        request([account(), account(reported=ABSENT, closed=month(5))]),
        None, None, None, "NULL_REPORT_DATE"),
    "reported next month": (request([account(reported=month(-1))]), None, None, None, "FUTURE_REPORT_DATE"),
    "no report number": (
        request(bureau_data__InquiryResponseHeader__ReportOrderNO=ABSENT),
        None, None, None, "NULL_REPORT_NUMBER"),
    "no limit score": (
        request(ftpl_features__g1=[{"label": "offline_bnpl_limit", "value": 1}]),
        None, None, None, "BAD_LIMIT_INPUT"),
    "nan limit": (request(base="nan"), None, None, None, "BAD_LIMIT_INPUT"),
    "nan score": (request(limit_score="NaN"), "True", "ETC", 500, None),
    "invalid and no limit": (
        request(bureau_data__Error=ERR, ftpl_features={}), None, None, None, "BAD_LIMIT_INPUT"),
}


def _frame(spark, documents):
    return spark.createDataFrame(list(documents), "request_id string, value string")


@pytest.fixture(scope="module")
def decided(spark):
    raw = _frame(spark, [(k, v[0]) for k, v in CASES.items()])
    fast = {r.request_id: r for r in decide_documents(raw, AS_OF).collect()}
    full = {
        r.request_id: r
        for r in score_requests(parse_requests(raw), AS_OF)
        .select("request_id", "accept_ind", "bureau_history_status", "bnpl_limit", "error_reason")
        .collect()
    }
    return fast, full


@pytest.mark.parametrize("case", list(CASES))
def test_case(decided, case):
    for result in decided:
        r = result[case]
        got = (r.accept_ind, r.bureau_history_status, r.bnpl_limit, r.error_reason)
        assert got == CASES[case][1:]


def test_launch_profile(spark):
    import json

    bare = lambda **kw: json.dumps(json.loads(request(**kw))["bureau_data"])
    raw = _frame(
        spark,
        [
            ("undated", bare(accounts=[account(opened=ABSENT)])),
            ("fresh", bare(accounts=[fresh()])),
            ("invalid", bare(bureau_data__Error=ERR)),
            ("nohit", bare(**{f"{REPORT}__Error": ERR})),
            ("broken", "{"),
        ],
    )
    got = {
        r.request_id: (r.accept_ind, r.bureau_history_status, r.bnpl_limit, r.error_reason)
        for r in decide_documents(raw, AS_OF, LAUNCH).collect()
    }
    assert got == {
        "undated": ("0", "ETC", None, None),
        "fresh": ("True", "NTC", None, None),
        "invalid": (None, "NA", None, None),
        "nohit": ("True", "NTC", None, None),
        "broken": (None, None, None, "BAD_JSON"),
    }


def test_strict_summary(spark):
    raw = _frame(spark, [("a", request(**{f"{REPORT}__CIRReportData__EnquirySummary": ABSENT}))])
    assert decide_documents(raw, AS_OF).first().accept_ind == "True"
    strict = dataclasses.replace(CURRENT, require_enquiry_summary=True)
    assert decide_documents(raw, AS_OF, strict).first().error_reason == "MISSING_ENQ_SUMMARY"
