"""Plan shape, agreement of the two forms, skew, streaming and batch output."""

import datetime as dt
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bridge import tables as t
from bridge.shapes import AS_OF
from tests import golden as g
from tradeline import (
    CURRENT, LAUNCH, decide_documents, decide_tables, parse_requests, read_request_files,
    read_requests, read_table, result_documents, run_batch, run_stream, schemas, score_requests,
    stream_requests, write_result_documents,
)
from tradeline.plans import export, ledger
from tradeline.session import new_path, work_folder
from tradeline.sources.sinks import complete_parts

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark):
    """The test documents as JSON lines on disk."""
    path = new_path(spark, "docs")
    t.documents(spark, SF).select("value").write.text(path)
    return path


def test_documents_need_no_shuffle_and_no_python(spark, folder):
    df = decide_documents(read_requests(spark, folder), AS_OF)
    plan = plan_of(df)
    assert "Exchange" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert len(re.findall(r"from_json\(StructField\(user_id", plan)) == 1


def test_tables_parse_once(spark, folder):
    scored = score_requests(parse_requests(read_requests(spark, folder)), AS_OF)
    for df in (
        export.account_table(scored), export.enquiry_table(scored, AS_OF),
        export.user_policy_table(scored), export.quarantine_table(scored),
    ):
        plan = plan_of(df)
        assert "Exchange" not in plan
        assert len(re.findall(r"from_json\(StructField\(user_id", plan)) == 1


def test_ledger_combines_before_the_shuffle(spark):
    plan = plan_of(ledger.account_facts(t.accounts(spark, SF), AS_OF))
    final, partial = plan.index("HashAggregate"), plan.rindex("HashAggregate")
    assert final < plan.index("Exchange hashpartitioning(request_id") < partial
    assert "partial_sum" in plan and "Python" not in plan


def test_pruned_scan(spark):
    plan = plan_of(ledger.enquiry_counts(t.enquiries(spark, SF), AS_OF))
    assert re.search(r"ReadSchema: struct<event_id:bigint,user_id:bigint>", plan)


def test_account_scan_reads_only_what_the_rollup_needs(spark):
    path = new_path(spark, "accounts")
    t.accounts(spark, SF).write.parquet(path)
    accounts = spark.read.parquet(path)
    plan = plan_of(ledger.account_facts(accounts, AS_OF))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "payment#" in read
    for unused in ("highcredit", "sanctionamount", "creditlimit"):
        assert unused not in read
    hit = plan_of(ledger.account_facts(accounts.where("request_id = 7"), AS_OF))
    assert "PushedFilters: [IsNotNull(request_id), EqualTo(request_id,7)]" in hit


def test_two_forms_agree(spark, folder):
    """Nested documents and exploded tables give the same decisions."""
    raw = t.documents(spark, SF)
    nested = decide_documents(raw, AS_OF)
    parsed = parse_requests(raw)
    flat = decide_tables(*ledger.tables_from_requests(parsed, AS_OF), AS_OF)
    a = {r.request_id: r for r in nested.collect()}
    b = {r.request_id: r for r in flat.collect()}
    outside = {"BAD_JSON", "MISSING_ENVELOPE", "BAD_NUMBER", "MISSING_HEADER", "MISSING_REPORT"}
    assert {a[k].error_reason for k in set(a) - set(b)} <= outside
    assert set(b) <= set(a) and len(b) > 100
    for key in b:
        assert a[key] == b[key]
    a = {k: r for k, r in a.items() if r.error_reason is None}
    assert {"BAD_LIMIT_INPUT"} < {r.error_reason for r in b.values()}
    assert {r.accept_ind for r in a.values()} == {"True", "False", "0", None}
    assert {r.bureau_history_status for r in a.values()} == {"ETC", "NTC", "NA"}


def test_launch_tables(spark):
    """The launch profile needs no limit inputs and does not call undated files thin."""
    requests = t.requests(spark, SF).drop("base_limit", "limit_score", "min_income", "max_income")
    accounts, enquiries = t.accounts(spark, SF), t.enquiries(spark, SF)
    undated = accounts.withColumn("opened", F.lit(None).cast("date"))
    rows = decide_tables(requests, undated, enquiries, AS_OF, LAUNCH).where(
        "bureau_history_status <> 'NA'"
    )
    got = {(r.accept_ind, r.bureau_history_status, r.bnpl_limit, r.error_reason) for r in rows.collect()}
    assert got == {("True", "NTC", None, None), ("0", "ETC", None, None)}


# Reports with a dated account at sf 0.01 and how many fail each rule, worked out
# beforehand by two independent computations.
EXPECTED = {
    "0.001": (141, [0, 16, 40, 0, 6, 2, 1, 6, 4, 7, 1, 27], 73),
    "0.01": (1410, [1, 190, 398, 8, 45, 24, 8, 50, 38, 58, 9, 262], 697),
}


@pytest.mark.parametrize("scale", list(EXPECTED))
def test_expected_rule_counts(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    accounts = t.accounts(spark, sf)
    # The expectation was made for single-account thin files.
    first = accounts.groupBy("request_id").agg(F.min("acct_number").alias("first"))
    accounts = accounts.join(first, "request_id").where(
        ~(F.col("request_id") % 50).isin(2, 3) | (F.col("acct_number") == F.col("first"))
    ).drop("first")
    rows = ledger.user_policy_rows(
        ledger.policy_table(t.requests(spark, sf), accounts, t.enquiries(spark, sf), AS_OF)
    )
    names = [r.name for r in CURRENT.rules]
    passed = " AND ".join(names)
    r = rows.agg(
        F.count("*").alias("n"), *[F.count_if(~F.col(n)).alias(n) for n in names],
        F.count_if(F.expr(passed)).alias("ok"),
    ).first()
    assert (r.n, [r[n] for n in names], r.ok) == EXPECTED[scale]


def test_skewed_facts_are_split_at_run_time(spark):
    """One key with a third of all rows is dealt out over tasks, and nothing is lost."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    rows = spark.range(0, 300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("request_id"),
        F.col("id").alias("a"),
    )
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = ledger.with_report_facts(rows, {"late": F.col("a") > 299_990})
        tasks = got.groupBy("request_id", F.spark_partition_id().alias("task")).count().collect()
        late = got.where("late").select("request_id").distinct().collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["count"] for r in tasks) == 300_000
    hot = [r["count"] for r in tasks if r.request_id == -1]
    assert sum(hot) == 100_000 and len(hot) > 1 and max(hot) < 60_000
    assert {r.request_id for r in late} == {-1} | {i % 500 for i in range(299_991, 300_000) if i % 3}


def test_account_order_and_unknown_codes_do_not_matter(spark):
    bad = {2: "60+", 9: "30+"}
    one = [g.account(number="1", history=g.cells(payment=bad)), g.account(number="2"), g.account(number="3")]
    other = [g.account(history=g.cells(payment={i: c for i in range(48)})) for c in ("ZZZ", None)]
    docs = [("a", g.request(one)), ("b", g.request(one[::-1])), ("u", g.request([other[0], g.account()])),
            ("n", g.request([other[1], g.account()]))]
    raw = spark.createDataFrame(docs, "request_id string, value string")
    rows = {r.request_id: r for r in score_requests(parse_requests(raw), AS_OF).select("request_id", "policy", "accept_ind").collect()}
    assert rows["a"].policy == rows["b"].policy and rows["a"].accept_ind == "False"
    assert rows["u"].policy == rows["n"].policy


def test_later_date_shifts_the_window(spark):
    raw = spark.createDataFrame(
        [("a", g.request([g.account(history=g.cells(payment={0: "90+"}))]))], "request_id string, value string"
    )
    parsed = parse_requests(raw)
    for ago, when in enumerate([AS_OF, dt.date(2024, 2, 1), dt.date(2024, 3, 31)]):
        row = export.account_table(score_requests(parsed, when)).first()
        filled = [k for k in range(49) if row[f"acctst_l{k}m"] == 4]
        assert filled == [ago]
        assert row.dpd90_pol_l12m == (ago > 0)


def test_batch_and_stream_agree(spark, folder):
    """A batch, and two streams with checkpoints of their own, write to one folder side by side."""
    out, checkpoints = new_path(spark, "out"), [new_path(spark, "checkpoint") for _ in "ab"]
    run_batch(read_requests(spark, folder), out, AS_OF, run="batch")
    for checkpoint in (checkpoints[0], *checkpoints):  # a second start finds nothing new
        run_stream(
            stream_requests(spark, folder, files_per_batch=2), out, checkpoint, AS_OF
        ).awaitTermination()
    parts = complete_parts(spark, out)
    runs = {p.split("/")[1] for p in parts}
    assert len(runs) == 3 and "run=batch" in runs and len(parts) > 4
    for table in ("decision", "bureau", "enquiry", "user_policy", "quarantine"):
        rows = read_table(spark, out, table)
        own = [rows.where(F.col("run") == r.removeprefix("run=")).drop("as_of", "run", "batch") for r in sorted(runs)]
        plain = [df.drop("request_id") for df in own]
        assert plain[0].count() > 0
        assert plain[0].exceptAll(plain[1]).count() == plain[1].exceptAll(plain[0]).count() == 0
        assert plain[0].exceptAll(plain[2]).count() == plain[2].exceptAll(plain[0]).count() == 0


def test_run_is_replaced_by_itself_only(spark, folder):
    out = new_path(spark, "out")
    raw = read_requests(spark, folder)
    n = raw.count()
    for run, rows in (("a", raw), ("b", raw.limit(7)), ("a", raw)):
        assert run_batch(rows, out, AS_OF, run=run) == run
    counts = {r.run: r["count"] for r in read_table(spark, out, "decision").groupBy("run").count().collect()}
    assert counts == {"a": n, "b": 7}
    assert run_batch(raw.limit(1), out, AS_OF) not in ("a", "b")
    with pytest.raises(ValueError):
        run_batch(raw, out, AS_OF, run="a/b")


def test_incomplete_run_is_not_read(spark, folder, monkeypatch):
    """A failure between the tables leaves nothing that readers would take for a result."""
    from tradeline.session import Files

    out = new_path(spark, "out")
    raw = read_requests(spark, folder)
    run_batch(raw.limit(5), out, AS_OF, run="good")
    move, calls = Files.move, []

    def broken(self, source, target):
        calls.append(target)
        if len(calls) == 3:
            raise OSError("lost")
        move(self, source, target)

    monkeypatch.setattr(Files, "move", broken)
    with pytest.raises(OSError):
        run_batch(raw, out, AS_OF, run="bad")
    assert {r.run for r in read_table(spark, out, "decision").collect()} == {"good"}
    monkeypatch.undo()
    run_batch(raw, out, AS_OF, run="bad")
    assert read_table(spark, out, "decision").count() == 5 + raw.count()


def test_batch_leaves_no_intermediate_copy(spark, folder):
    work = Path(work_folder(spark))
    before = set(work.iterdir())
    run_batch(read_requests(spark, folder), f"{work}/kept-out", AS_OF)
    assert {p.name for p in set(work.iterdir()) - before} == {"kept-out"}


def test_requests_keep_their_own_keys(spark):
    """Equal documents are separate requests; a named field can hold the id."""
    same = g.request([g.account(history=g.cells(payment={0: "01+"}))])
    path = new_path(spark, "same")
    spark.createDataFrame([(same,)] * 3, "value string").coalesce(1).write.text(path)
    raw = read_requests(spark, path)
    rows = raw.collect()
    assert len({r.request_id for r in rows}) == 3 and len({r.digest for r in rows}) == 1
    assert {r.request_id for r in raw.collect()} == {r.request_id for r in rows}
    flat = decide_tables(*ledger.tables_from_requests(parse_requests(raw), AS_OF), AS_OF).collect()
    nested = decide_documents(raw, AS_OF).collect()
    assert sorted(map(str, flat)) == sorted(map(str, nested)) and len(flat) == 3
    named = read_requests(spark, path, id_field="user_id")
    assert {r.request_id for r in named.collect()} == {json.loads(same)["user_id"]}


def test_scan_for_a_score_leaves_histories_alone(spark, folder):
    from tradeline.operators import parse

    raw = read_requests(spark, folder)
    df = parse_requests(raw, parts=["ScoreDetails"])
    plan = plan_of(df.select("request_id", parse.read_score(F.col("score_details"), 99999)))
    assert "History48Months" not in plan and "Enquiries" not in plan
    assert "History48Months" in plan_of(parse_requests(raw).select("raw_accounts"))


@pytest.mark.parametrize("n", [1, 100, 5000])
def test_documents_of_any_size(spark, n):
    late = g.account(history=g.cells(payment={1: "90+"}))
    accounts = [g.account(number=str(i)) for i in range(n - 1)] + [late]
    raw = spark.createDataFrame([("r", g.request(accounts))], "request_id string, value string")
    scored = score_requests(parse_requests(raw), AS_OF)
    row = scored.first()
    assert (row.accept_ind, row.policy.cnt_accts, row.policy.cnt_dpd90_l12m_accts) == ("False", n, 1)
    assert export.account_table(scored).count() == n


def test_missing_limit_score(spark):
    """Without a score there is no limit, in either form; NaN is in the lowest band."""
    docs = [("none", g.request(ftpl_features__g1=[{"label": "offline_bnpl_limit", "value": 2000}])), ("nan", g.request(limit_score="NaN"))]
    raw = spark.createDataFrame(docs, "request_id string, value string")
    for rows in (decide_documents(raw, AS_OF), decide_tables(*ledger.tables_from_requests(parse_requests(raw), AS_OF), AS_OF)):
        got = {r.request_id: (r.bnpl_limit, r.error_reason) for r in rows.collect()}
        assert got["none"] == (None, "BAD_LIMIT_INPUT")
        assert got["nan"] == (500, None)


def test_stream_without_a_date_keeps_the_day_of_its_batch(spark, folder, monkeypatch):
    from tradeline.streaming import decisions

    out, checkpoint = new_path(spark, "out"), new_path(spark, "checkpoint")
    run_stream(stream_requests(spark, folder), out, checkpoint).awaitTermination()
    days = {r.as_of for r in read_table(spark, out, "decision").select("as_of").distinct().collect()}
    assert len(days) == 1 and abs((days.pop() - dt.date.today()).days) <= 1
    files = decisions.Files(spark, out)
    first = decisions._decision_date(files, out, "x", 5)

    class Later(dt.date):
        @classmethod
        def today(cls):
            return dt.date(2099, 1, 1)

    monkeypatch.setattr(decisions.dt, "date", Later)
    assert decisions._decision_date(files, out, "x", 5) == first
    assert decisions._decision_date(files, out, "x", 6) == dt.date(2099, 1, 1)


def test_documents_hold_every_column_of_the_tables(spark, folder):
    """The column dictionaries against the tables: 271, 8 and 26 columns, both profiles."""
    for cfg, raw in (
        (CURRENT, read_requests(spark, folder)), (LAUNCH, t.documents(spark, SF, envelope=False)),
    ):
        scored = score_requests(parse_requests(raw.limit(60), cfg), AS_OF, cfg).cache()
        docs = {r.request_id: json.loads(r.value) for r in result_documents(scored, AS_OF, cfg).collect()}
        names = {} if cfg.envelope else schemas.launch_names(cfg.user_column)
        for kind, df in (
            ("bureau", export.account_table(scored, cfg)), ("enquiry", export.enquiry_table(scored, AS_OF, cfg)),
            ("user", export.user_policy_table(scored)),
        ):
            rows = {}
            for r in export.dates_as_text(df).collect():
                rows.setdefault(r.request_id, []).append(r.asDict())
            for key, doc in docs.items():
                data = doc["analytics_data"] if cfg.envelope else doc
                part = data[{
                    "bureau": ("Bur_Data", "bur_processed_bnpl_data"), "enquiry": ("Enq_Data", "enquiry_bnpl_data"),
                    "user": ("df_User", "user_aggregated_policy_data"),
                }[kind][cfg.envelope]]
                if key not in rows:
                    assert part is None or not any(part.values())
                    continue
                columns = [c for c in df.columns if c != "request_id"]
                if kind == "user" and not cfg.envelope:
                    columns.remove("reportnumber")
                assert set(part) == {names.get(c, c) for c in columns}
                want = sorted(str([r[c] for c in columns]) for r in rows[key])
                index = list(part[names.get(columns[0], columns[0])])
                got = sorted(str([part[names.get(c, c)][i] for c in columns]) for i in index)
                assert got == want
        scored.unpersist()


def test_result_document(spark):
    accounts = [g.account(number="old", reported=g.month(50)), g.account(number="new")]
    raw = spark.createDataFrame(
        [("r", g.request(accounts, enq=g.enquiries(1, 9))), ("bad", "{")], "request_id string, value string"
    )
    docs = result_documents(score_requests(parse_requests(raw), AS_OF), AS_OF).collect()
    assert [d.request_id for d in docs] == ["r"]
    doc = json.loads(docs[0].value)
    assert (doc["accept_ind"], doc["bureau_history_status"], doc["bnpl_limit"]) == ("True", "ETC", 800)
    data = doc["analytics_data"]
    bureau = data["bur_processed_bnpl_data"]
    assert len(bureau) == 271
    # Accounts with a visible history come first and keep their own ordinal.
    assert bureau["acct_number"] == {"0": "new", "1": "old"}
    assert bureau["acct_uniq_id"] == {"0": 1, "1": 0}
    assert bureau["phonetype"] == {"0": "M", "1": "M"}
    assert bureau["acctst_l0m"] == {"0": 0, "1": None}
    assert bureau["dateopened_n"] == {"0": "2022-01-01 00:00:00", "1": "2022-01-01 00:00:00"}
    assert data["enquiry_bnpl_data"]["inq_flag"] == {"0": True, "1": False}
    assert data["user_aggregated_policy_data"]["cnt_accts"] == {"0": 2}


def test_launch_documents_by_file(spark):
    """One report per file in, one result per file out; equal names in two folders stay apart."""
    import tempfile

    inbox = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    for name, accounts in (("x/r.json", [g.account()]), ("y/r.json", [g.account(opened=g.ABSENT)])):
        (inbox / name).parent.mkdir()
        (inbox / name).write_text(json.dumps(json.loads(g.request(accounts))["bureau_data"], indent=1))
    raw = read_request_files(spark, str(inbox))
    assert {r.file_name for r in raw.collect()} == {"x/r.json", "y/r.json"}
    assert len({r.request_id for r in raw.collect()}) == 2
    scored = score_requests(parse_requests(raw, LAUNCH), AS_OF, LAUNCH)
    documents = result_documents(scored, AS_OF, LAUNCH)
    lines, out = new_path(spark, "results"), new_path(spark, "results")
    write_result_documents(documents, lines)
    by_name = {x["file_name"]: x["result"] for x in (json.loads(r.value) for r in spark.read.text(lines).collect())}
    write_result_documents(documents, out, per_file=True)
    results = {
        r.result: json.loads(r.value) for r in spark.read.option("basePath", out).text(out).collect()
    }
    assert results == {f"processed_file_{k}": v for k, v in by_name.items()}
    a, b = results["processed_file_x/r.json"], results["processed_file_y/r.json"]
    assert set(a) == {"Bur_Hist_Sta", "Bur_Data", "Enq_Data", "df_User", "Accpt_Ind"}
    assert (a["Accpt_Ind"], a["Bur_Hist_Sta"]) == ("True", "ETC")
    assert a["df_User"]["Cnt_Accts"] == {"R1": 1} and "REPORTNUMBER" not in a["df_User"]
    assert {"Cnt_OverDue_Accts_Dec", "Cnt_DPD30_L12M_Accts_Rt_Dec", "Max_Inq_L3M"} < set(a["df_User"])
    assert a["Bur_Data"]["ACCT_NUMBER"] == {"0": "A1"} and a["Bur_Data"]["AcctSt_L0M"] == {"0": 0}
    assert {"Input_Detail_Type", "DPD30_Pol_l3m_cnt", "Non_Avail_Per", "seq"} < set(a["Bur_Data"])
    assert (b["Accpt_Ind"], b["Bur_Hist_Sta"], b["df_User"]) == ("0", "ETC", None)


def _accounts(spark, accounts, cfg=CURRENT):
    text = g.request(accounts)
    if not cfg.envelope:
        text = json.dumps(json.loads(text)["bureau_data"])
    raw = spark.createDataFrame([("r", text)], "request_id string, value string")
    scored = score_requests(parse_requests(raw, cfg), AS_OF, cfg)
    return export.account_table(scored, cfg).orderBy("acct_uniq_id").collect()


def test_account_columns(spark):
    clean = g.cells(suit={0: "*"})
    rows = _accounts(
        spark,
        [
            g.account(opened="2020-03-15", closed="2021-05-01", history=clean, CreditLimit="9"),
            g.account(opened="01/02/2023", history=clean, CreditLimit="8"),
            g.account(opened=g.ABSENT, history=clean),
        ],
    )
    # Tenure counts the opening month twice over; the undated account is gone.
    assert [(r.acct_uniq_id, r.tenure_clo_ope, r.tenure_avai) for r in rows] == [(0, 20, 20), (1, None, 15)]
    # Only credit limits were sent, so they stand in for the high credit.
    assert [r.highcredit for r in rows] == ["9", "8"]
    assert [r.suitfiledstatus for r in rows] == ["*", "*"]
    assert [(r.key_0, r.key_47, r.key_48) for r in rows] == [("m0", "m47", None)] * 2
    assert (rows[0].dateclosed_n, rows[1].dateopened_n) == (dt.datetime(2021, 5, 1), dt.datetime(2023, 2, 1))
    assert [r.score for r in rows] == [750, 750] and rows[0].total == "1"


def test_fallbacks_are_per_report(spark):
    pair = [g.account(HighCredit="5", SuitFiledStatus="NS"), g.account(CreditLimit="7")]
    assert [(r.highcredit, r.suitfiledstatus) for r in _accounts(spark, pair)] == [("5", "NS"), (None, None)]
    launch = [(r.highcredit, r.suitfiledstatus) for r in _accounts(spark, pair, LAUNCH)]
    assert launch == [("5", "NS"), (None, "NS")]
    mixed = [g.account(HighCredit="5"), g.account(SanctionAmount="6", CreditLimit="7")]
    assert [r.highcredit for r in _accounts(spark, mixed)] == ["5", "6"]


def test_49th_month_stays_text(spark):
    row = _accounts(spark, [g.account(history=g.cells(50, payment={48: "60+", 47: "30+"}))])[0]
    assert (row.acct_st_49, row.suit_filed_st_49, row.asset_cl_st_49) == ("60+", "NS", "STD")
    assert (row.acctst_l47m, row.acctst_l48m, row.key_48) == (2, None, "m48")


def test_no_hit_rows(spark):
    """A request without accounts gives one row per phone or product."""
    patch = {"bureau_data__CCRResponse__CIRReportDataLst__0__Error": {"ErrorCode": "00", "ErrorDesc": "none"}}
    phones = [{"seq": "1", "PhoneType": ["H"], "Number": "1"}, {"seq": "2", "PhoneType": "Mob", "Number": "2"}]
    raw = spark.createDataFrame([("n", g.request(phones=phones, **patch))], "request_id string, value string")
    rows = export.account_table(score_requests(parse_requests(raw), AS_OF)).orderBy("number").collect()
    got = [(r.number, r.phonetype, r.errorcode, r.reportnumber, r.bur_hist_sta, r.seq, r.acct_number) for r in rows]
    assert got == [("1", "H", "00", "R1", "NTC", None, None), ("2", "M", None, None, "NTC", None, None)]


def test_rules_are_data(spark):
    """Thresholds can change and rules can go, in both forms."""
    import dataclasses

    rules = [r for r in CURRENT.rules if r.name != "max_score_dec"]
    rules[2] = dataclasses.replace(rules[2], limit=0)
    cfg = dataclasses.replace(CURRENT, rules=tuple(rules))
    late = g.account(history=g.cells(payment={0: "01+"}))
    docs = [("low", g.request(score="300")), ("due", g.request([late]))]
    raw = spark.createDataFrame(docs, "request_id string, value string")
    for policy, want in ((CURRENT, {"low": "False", "due": "True"}), (cfg, {"low": "True", "due": "False"})):
        parsed = parse_requests(raw, policy)
        nested = score_requests(parsed, AS_OF, policy)
        requests = nested.select(
            "request_id", "reportnumber", "route", "score", F.lit(1.0).alias("limit_score"),
            F.lit(1.0).alias("base_limit"), F.lit(0.0).alias("min_income"), F.lit(0.0).alias("max_income"),
        )
        accounts = ledger.accounts_from_requests(parsed, AS_OF)
        none = spark.createDataFrame([], "request_id string, date date")
        flat = decide_tables(requests, accounts, none, AS_OF, policy)
        for df in (nested, flat):
            assert {r.request_id: r.accept_ind for r in df.collect()} == want


def test_conform(spark):
    df = spark.createDataFrame([(1, float("nan"), "x", "drop")], "SEQ int, Amount double, Date string, other string")
    out = export.conform(df, (("seq", "string"), ("amount", "double"), ("date", "string"), ("time", "string")))
    assert out.columns == ["seq", "amount", "date", "time"]
    assert out.first() == ("1", None, "x", None)


def test_command_line(spark, folder):
    from tradeline.__main__ import arguments, main

    out, docs = new_path(spark, "cli"), new_path(spark, "cli-docs")
    main(["batch", "--requests", folder, "--out", out, "--as-of", "2024-01-31", "--documents", docs])
    decided = read_table(spark, out, "decision")
    ok = decided.where("error_reason IS NULL").count()
    assert ok == spark.read.text(docs).count() > 0
    assert decided.count() == ok + read_table(spark, out, "quarantine").count()
    for wrong in (["stream", "--as-of", "2024-01-31"], ["batch"]):
        with pytest.raises(SystemExit):
            arguments([wrong[0], "--requests", "a", "--out", "b", *wrong[1:]])
    assert arguments(["stream", "--requests", "a", "--out", "b", "--checkpoint", "c"]).files_per_batch == 1000
