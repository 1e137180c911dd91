"""Dates of their own, several policies, key presence, and flat tables made or stored once."""

import dataclasses
import datetime as dt
import re
import time
import uuid

import pytest
from pyspark.sql import functions as F

from bridge import tables as t
from bridge.shapes import AS_OF
from tests import golden as g
from tradeline import (
    CURRENT, LAUNCH, decide_documents, decide_policies, decide_policies_tables, decide_tables, parse_requests,
    read_requests, read_table, run_batch, run_stream, score_requests, stream_requests,
)
from tradeline.functions.dates import parse_date
from tradeline.operators import parse
from tradeline.plans import export, ledger
from tradeline.session import new_path
from tradeline.sources import flat

SF = "/root/testdata/sf0.001"
OTHER = dataclasses.replace(CURRENT, min_score=800, dpd30=1, enquiry_months=9, thin_max_mob=30)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """The test documents as they were made once."""
    path = new_path(spark, "docs")
    t.documents(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def rows_of(df):
    return sorted(map(str, df.collect()))


def tables(spark):
    return t.requests(spark, SF), t.accounts(spark, SF), t.enquiries(spark, SF)


def test_one_date_stays_a_literal(spark, stored):
    month = str(AS_OF.year * 12 + AS_OF.month)
    for df in (decide_documents(stored, AS_OF), ledger.account_facts(t.accounts(spark, SF), AS_OF)):
        assert month in plan_of(df)
    dated = decide_documents(stored.withColumn("as_of", F.lit(AS_OF)), F.col("as_of"))
    plan = plan_of(dated)
    assert "Exchange" not in plan and len(re.findall(r"from_json\(StructField\(user_id", plan)) == 1
    assert rows_of(dated) == rows_of(decide_documents(stored, AS_OF))


def test_each_date_decides_as_a_job_of_its_own(spark):
    own = F.expr("add_months(DATE '2024-01-31', CAST(request_id AS INT) % 3 * 5)")
    raw = t.documents(spark, SF).withColumn("as_of", own)
    together = decide_documents(raw, F.col("as_of"))
    parsed = parse_requests(raw)
    flat_together = decide_tables(*ledger.tables_from_requests(parsed, F.col("as_of")), F.col("as_of"))
    apart, flat_apart = [], []
    for k, date in enumerate((AS_OF, dt.date(2024, 6, 30), dt.date(2024, 11, 30))):
        part = t.documents(spark, SF).where(f"CAST(request_id AS INT) % 3 = {k}")
        apart += rows_of(decide_documents(part, date))
        flat_apart += rows_of(decide_tables(*ledger.tables_from_requests(parse_requests(part), date), date))
    assert rows_of(together) == sorted(apart)
    assert rows_of(flat_together) == sorted(flat_apart)


def test_a_missing_date_is_an_error_of_the_request(spark):
    raw = spark.createDataFrame([("a", g.request(), AS_OF), ("b", g.request(), None)], "request_id string, value string, as_of date")
    reasons = {r.request_id: r.error_reason for r in decide_documents(raw, F.col("as_of")).collect()}
    assert reasons == {"a": None, "b": "MISSING_DATE"}
    flat_rows = decide_tables(*ledger.tables_from_requests(parse_requests(raw), F.col("as_of")), F.col("as_of"))
    assert {r.request_id: r.error_reason for r in flat_rows.collect()} == reasons


def test_short_years_go_to_the_century_of_their_row(spark):
    rows = [("1/2/30", dt.date(2024, 1, 1)), ("1/2/30", dt.date(1975, 1, 1)), ("1/2/99", dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "text string, as_of date")
    got = [r[0].year for r in df.select(parse_date(F.col("text"), F.col("as_of"), True)).collect()]
    want = [df.where(f"as_of = DATE '{d}'").select(parse_date(F.lit(x), d, True)).first()[0].year for x, d in rows]
    assert got == want == [2030, 1930, 1999]


def test_batch_and_stream_write_a_part_for_each_date(spark):
    """The date is a field of the document."""
    inbox, out, checkpoint = (new_path(spark, name) for name in ("dated", "dated-out", "dated-checkpoint"))
    days = ["2024-01-31", "2024-02-29", None]
    docs = [g.request([g.account(number=str(i))])[:-1] + (f', "day": "{days[i % 3]}"' if days[i % 3] else "") + "}" for i in range(9)]
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(inbox)
    raw = read_requests(spark, inbox, date_field="day")
    run_batch(raw, out, F.col("as_of"), run="own")
    run_batch(raw, out, F.col("as_of"), run="own")
    run_stream(stream_requests(spark, inbox, date_field="day"), out, checkpoint, F.col("as_of")).awaitTermination()
    decision = read_table(spark, out, "decision")
    for run in [r[0] for r in decision.select("run").distinct().collect()]:
        counts = {str(r.as_of): r["count"] for r in decision.where(F.col("run") == run).groupBy("as_of").count().collect()}
        assert counts == {"2024-01-31": 3, "2024-02-29": 3, "None": 3}
    assert decision.select("run").distinct().count() == 2
    errors = {r.error_reason for r in read_table(spark, out, "quarantine").collect()}
    assert errors == {"MISSING_DATE"}
    lags = read_table(spark, out, "bureau").where("run = 'own'").select(F.col("as_of").cast("string"), "non_avail_per").distinct().collect()
    assert sorted(map(tuple, lags)) == [("2024-01-31", 0), ("2024-02-29", 1)]


def test_policies_share_one_parse(spark, stored):
    policies = {"current": CURRENT, "launch": LAUNCH, "other": OTHER}
    df = decide_policies(stored, AS_OF, policies)
    plan = plan_of(df)
    assert "Exchange" not in plan
    assert len(re.findall(r"from_json\(StructField\(user_id", plan)) == 1 and plan.count("Scan parquet") == 1
    for name, cfg in policies.items():
        own = df.where(F.col("policy_name") == name).drop("policy_name")
        if cfg.envelope:
            assert rows_of(own) == rows_of(decide_documents(stored, AS_OF, cfg))
    assert df.groupBy("policy_name").count().select("count").distinct().count() == 1


def test_policies_share_one_shuffle(spark):
    policies = {"current": CURRENT, "launch": LAUNCH, "other": OTHER}
    df = decide_policies_tables(*tables(spark), AS_OF, policies)
    one = decide_tables(*tables(spark), AS_OF, CURRENT)
    assert plan_of(df).count("Exchange hashpartitioning") == plan_of(one).count("Exchange hashpartitioning")
    assert plan_of(df).count("Scan parquet") == plan_of(one).count("Scan parquet") == 3
    for name, cfg in policies.items():
        own = df.where(F.col("policy_name") == name).drop("policy_name")
        assert rows_of(own) == rows_of(decide_tables(*tables(spark), AS_OF, cfg))


def test_a_key_that_is_null_everywhere_is_there(spark):
    cfg = dataclasses.replace(CURRENT, key_presence=True)
    cases = {
        "absent": [{"CreditLimit": "9"}], "null": [{"CreditLimit": "9", "HighCredit": None}],
        "other": [{"CreditLimit": "9", "SanctionAmount": None}], "one": [{"CreditLimit": "9"}, {"HighCredit": "5"}],
        "both": [{"HighCredit": None, "SanctionAmount": "7"}], "suit": [{"CreditLimit": "9", "SuitFiledStatus": None}],
    }
    raw = spark.createDataFrame(
        [(name, g.request([g.account(number=str(i), **a) for i, a in enumerate(accounts)])) for name, accounts in cases.items()],
        "request_id string, value string",
    )

    def got(policy):
        table = export.account_table(score_requests(parse_requests(raw, policy), AS_OF, policy), policy)
        rows = table.orderBy("request_id", "acct_uniq_id").collect()
        return {n: [(r.highcredit, r.suitfiledstatus) for r in rows if r.request_id == n] for n in cases}

    exact, usual = got(cfg), got(CURRENT)
    assert exact == {
        "absent": [("9", "NS")], "null": [(None, "NS")], "other": [(None, "NS")], "one": [(None, "NS"), ("5", "NS")],
        "both": [("7", "NS")], "suit": [("9", None)],
    }
    assert usual == exact | {"null": [("9", "NS")], "other": [("9", "NS")], "suit": [("9", "NS")]}


def test_bare_reports_know_their_keys_too(spark):
    cfg = dataclasses.replace(LAUNCH, key_presence=True)
    raw = t.documents(spark, SF, envelope=False)
    keys = parse_requests(raw, cfg).select("account_keys").where("account_keys is not null").first()[0]
    assert {"AccountNumber", "History48Months", "DateOpened"} <= set(keys)
    assert rows_of(decide_documents(raw, AS_OF, cfg)) == rows_of(decide_documents(raw, AS_OF, LAUNCH))


def test_saved_flat_tables_parse_the_documents_once(spark, stored):
    parsed = parse_requests(stored)
    path = new_path(spark, "flat")
    saved = ledger.tables_from_requests(parsed, AS_OF, saved=path)
    lazy = ledger.tables_from_requests(parsed, AS_OF)
    table = ledger.account_table(*saved, AS_OF)
    assert set(table.inputFiles()) == set(spark.read.parquet(path).inputFiles())
    # One read of the accounts for the roll-up and one for the rows.
    plan = plan_of(table)
    assert len(re.findall(r"FileScan parquet \[[^\]]*raw_accounts", plan)) == 2, plan[:20000]
    assert rows_of(table) == rows_of(ledger.account_table(*lazy, AS_OF))


def test_bucketed_tables_are_not_shuffled(spark, stored):
    name, path = f"b{uuid.uuid4().hex}", new_path(spark, "bucketed")
    parsed = parse_requests(stored)
    flat.write_flat_tables(ledger.tables_from_requests(parsed, AS_OF), name, path, buckets=4)
    tables = flat.read_flat_tables(spark, name)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plans = [plan_of(decide_tables(*tables, AS_OF)), plan_of(ledger.account_table(*tables, AS_OF))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not any("Exchange" in plan for plan in plans)
    assert rows_of(decide_tables(*tables, AS_OF)) == rows_of(decide_tables(*ledger.tables_from_requests(parsed, AS_OF), AS_OF))


def test_enquiries_alone_are_read_for_their_table(spark, stored):
    raw = stored
    rows = score_requests(parse_requests(raw, detail=("Enquiries",)), AS_OF, detail=("enquiries",))
    whole = score_requests(parse_requests(raw), AS_OF)
    assert rows_of(export.enquiry_table(rows, AS_OF)) == rows_of(export.enquiry_table(whole, AS_OF))
    assert "CollateralType" not in plan_of(rows) and "RequestPurpose" in plan_of(rows)


@pytest.mark.parametrize("n", [0, 1, 30_000])
def test_feature_map_of_many_labels(spark, n):
    entries = [(f"l{i}", str(i)) for i in range(n)] + [("l0", "5.5"), (None, "7"), ("x", None)]
    df = spark.createDataFrame([(entries,), ([],), (None,)], "features array<struct<label: string, value: string>>")
    began = time.perf_counter()
    got = [r[0] for r in df.select(parse.feature_map(F.col("features"))).collect()]
    assert time.perf_counter() - began < 20
    assert got == [{f"l{i}": float(i) for i in range(n)} | {"l0": 5.5, "x": None}, {}, None]
