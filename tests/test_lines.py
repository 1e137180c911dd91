"""Result documents as lines."""

import json

import pytest
from pyspark.sql import functions as F

from bridge import tables as t
from bridge.shapes import AS_OF
from tests import golden as g
from tradeline import CURRENT, LAUNCH, parse_requests, score_requests
from tradeline.plans import export, lines
from tradeline.session import new_path

SF = "/root/testdata/sf0.001"


def whole(rows):
    """Request -> its lines in order, as one text."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.request_id, r.line)):
        out[r.request_id] = out.get(r.request_id, "") + ("\n" if r.request_id in out else "") + r.value
    return out


@pytest.mark.parametrize("cfg", [CURRENT, LAUNCH], ids=["current", "launch"])
def test_lines_form_the_documents(spark, cfg):
    raw = t.documents(spark, SF, envelope=cfg.envelope).where("CAST(request_id AS INT) % 3 <> 2")
    path = new_path(spark, "scored")
    score_requests(parse_requests(raw, cfg), AS_OF, cfg).write.parquet(path)
    scored = spark.read.parquet(path)
    found = lines.result_lines(scored, AS_OF, cfg, rows_per_line=2).collect()
    assert max(r.line for r in found) > 1 << 40
    want = {r.request_id: json.loads(r.value) for r in export.result_documents(scored, AS_OF, cfg).collect()}
    assert {i: json.loads(text) for i, text in whole(found).items()} == want and len(want) > 50


def test_a_report_with_very_many_accounts(spark):
    n = 5000
    accounts = [g.account(number=f"A{i}", history=g.cells(2)) for i in range(n)]
    raw = spark.createDataFrame([("big", g.request(accounts, enq=g.enquiries(*range(900)))), ("small", g.request())], "request_id string, value string")
    scored = score_requests(parse_requests(raw), AS_OF)
    path = new_path(spark, "lines")
    lines.write_lines(lines.result_lines(scored, AS_OF), path)
    rows = spark.read.parquet(path).collect()
    assert max(len(r.value) for r in rows) < 500 * 60
    documents = whole(rows)
    assert set(documents) == {"big", "small"} and documents["small"].count("\n") == 0
    tables = json.loads(documents["big"])["analytics_data"]
    bureau = tables["bur_processed_bnpl_data"]
    assert len(bureau) == 271 and {len(column) for column in bureau.values()} == {n}
    assert bureau["acct_number"] == {str(i): f"A{i}" for i in range(n)}
    assert len(tables["enquiry_bnpl_data"]["date_n"]) == 900
    assert tables["user_aggregated_policy_data"]["cnt_accts"] == {"0": n}


def test_no_requests_and_odd_sizes(spark):
    raw = spark.createDataFrame([("a", g.request()), ("b", "{")], "request_id string, value string")
    scored = score_requests(parse_requests(raw), AS_OF)
    assert [r.request_id for r in lines.result_lines(scored, AS_OF).collect()] == ["a"]
    assert lines.result_lines(scored.where(F.lit(False)), AS_OF).collect() == []
    with pytest.raises(ValueError):
        lines.result_lines(scored, AS_OF, rows_per_line=0)
