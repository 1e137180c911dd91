"""Metrics kept by month, ids that are found again, and decisions from streams of tables."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from bridge import tables as t
from bridge.shapes import AS_OF
from tests import golden as g
from tradeline import CURRENT, decide_table_streams, decide_tables, parse_requests, read_requests
from tradeline.plans import ledger, monthly
from tradeline.session import new_path, work_folder
from tradeline.sources import requests as src

SF = "/root/testdata/sf0.001"


def later(months: int) -> dt.date:
    n = AS_OF.year * 12 + AS_OF.month - 1 + months
    return dt.date(n // 12, n % 12 + 1, 28)


def facts(accounts, enquiries, as_of):
    """Request -> facts of the plan over accounts and enquiries."""
    joined = ledger.account_facts(accounts, as_of).join(ledger.enquiry_counts(enquiries, as_of), "request_id", "full")
    names = [*monthly.SUMS, *monthly.FLAGS, "max_mob"]
    return {r.request_id: tuple(r[n] or 0 for n in names) for r in joined.collect()}


def folded(changes, as_of):
    names = [*monthly.SUMS, *monthly.FLAGS, "max_mob"]
    return {r.request_id: tuple(r[n] or 0 for n in names) for r in monthly.facts_at(changes, as_of).collect()}


CODES = ["000", "01+", "30+", "60+", "90+", "SUB", "STD", "*", "ZZZ", None]
ACCOUNT = (
    "request_id long, acct_number string, opened date, reported date, closed date, balance double, writeoff double, "
    "suit_status string, payment array<string>, suit array<string>, asset array<string>, bad_number boolean, has_balance boolean"
)


def random_accounts(spark, n, seed):
    rng = random.Random(seed)

    def day(low, high):
        return later(-rng.randrange(low, high)) if rng.random() < 0.95 else None

    def codes(usual, odd):
        return [rng.choice(odd) if rng.random() < 0.1 else usual for _ in range(rng.randrange(0, 50))]

    rows = [
        (
            rng.randrange(n // 4), rng.choice([None, str(i)]), day(0, 120), day(0, 70), day(0, 50), rng.choice([None, 0.0, 5.0]),
            rng.choice([None, 0.0, 5.0]), rng.choice([None, "NS"]), codes("000", CODES), codes("NS", ["SF", "*", None, "TP"]),
            codes("STD", ["SUB", "DBT", "LOSS", None]), rng.random() < 0.1, rng.random() < 0.8,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, ACCOUNT)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_add_up_to_the_facts_of_every_month(spark, seed):
    accounts = random_accounts(spark, 400, seed).cache()
    enquiries = spark.createDataFrame(
        [(i % 150, None if i % 11 == 0 else later(-(i * 7 % 12))) for i in range(500)], "request_id long, date date"
    )
    changes = monthly.account_changes(accounts).unionByName(monthly.enquiry_changes(enquiries)).cache()
    for months in (0, 1, 2, 3, 5, 6, 11, 12, 13, 36, 47, 48, 49, 60):
        assert folded(changes, later(months)) == facts(accounts, enquiries, later(months)), months
    accounts.unpersist()
    changes.unpersist()


def test_deliveries_in_any_number_of_parts(spark):
    path = new_path(spark, "changes")
    accounts, enquiries = t.accounts(spark, SF), t.enquiries(spark, SF)
    for part in (0, 1, 2, 1):
        own = monthly.account_changes(accounts.where(f"acct_number % 3 = {part}"))
        monthly.save_delivery(own, path, f"part{part}")
    monthly.save_delivery(monthly.enquiry_changes(enquiries), path, "enquiries")
    changes = monthly.read_deliveries(spark, path)
    for months in (0, 9):
        as_of = later(months)
        want = sorted(map(str, decide_tables(t.requests(spark, SF), accounts, enquiries, as_of).collect()))
        assert sorted(map(str, monthly.decide_changes(t.requests(spark, SF), changes, as_of).collect())) == want
    requests = t.requests(spark, SF).withColumn("as_of", F.expr("add_months(DATE '2024-01-31', CAST(request_id % 5 AS INT))"))
    dated = [ledger.with_dates(rows, requests) for rows in (accounts, enquiries, changes)]
    want = decide_tables(requests, dated[0], dated[1], F.col("as_of")).collect()
    got = monthly.decide_changes(requests, dated[2], F.col("as_of")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_large_request_is_few_changes(spark):
    one = t.accounts(spark, SF).withColumn("request_id", F.lit(1).cast("bigint"))
    changes = monthly.account_changes(one)
    assert changes.count() < 20 * 150 < 10 * one.count()
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("HashAggregate")  # combined before the shuffle
    assert monthly.account_changes(one.limit(0)).collect() == []


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, master, warehouse, folder=None):
            settings = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": folder}
            self.conf = SimpleNamespace(get=lambda key, default=None: settings[key])
            self.sparkContext = SimpleNamespace(master=master)

    assert work_folder(Session("yarn", "file:/w", "hdfs://x/y/")) == "hdfs://x/y"
    assert work_folder(Session("yarn", "hdfs://x/w")) == "hdfs://x/w/work" and work_folder(Session("local[2]", "/w")) == "/w/work"
    for warehouse in ("/w", "file:/w"):
        with pytest.raises(ValueError):
            work_folder(Session("spark://host:7077", warehouse))


# --- ids ---------------------------------------------------------------------


def ids(spark, path, **settings):
    usual = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return sorted((r.request_id, r.digest) for r in read_requests(spark, path, stable_ids=True).collect())
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)


def test_ids_don_t_depend_on_packing_or_further_files(spark):
    path = new_path(spark, "lines")
    lines = [(f'{{"user_id": "u{i % 300}"}}',) for i in range(1000)] + [('{"user_id": "same"}',)] * 3000 + [("",), ("{",)]
    df = spark.createDataFrame(lines, "value string")
    df.coalesce(1).write.text(path)
    df.limit(50).coalesce(1).write.mode("append").text(path)
    first = ids(spark, path)
    assert len({i for i, _ in first}) == len(first) == len(lines) + 50
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    assert ids(spark, path, **small) == first
    spark.createDataFrame([("more",)] * 9, "value string").write.mode("append").text(path)
    again = ids(spark, path, **{"spark.sql.files.openCostInBytes": "1"})
    assert set(first) <= set(again) and len(again) == len(first) + 9


def test_many_repeated_documents_are_joined_by_shuffle(spark, monkeypatch):
    path = new_path(spark, "lines")
    spark.createDataFrame([(str(i % 40),) for i in range(200)], "value string").coalesce(2).write.text(path)
    want = ids(spark, path)
    monkeypatch.setattr(src, "BROADCAST_REPEATED", 0)
    assert ids(spark, path) == want and len({i for i, _ in want}) == 200


def test_a_named_field_goes_before(spark):
    path = new_path(spark, "lines")
    spark.createDataFrame([('{"id": "a"}',), ('{"id": null}',), ('{"id": null}',)], "value string").coalesce(1).write.text(path)
    found = [r.request_id for r in read_requests(spark, path, id_field="id", stable_ids=True).collect()]
    assert "a" in found and len(set(found)) == 3 and sum(i.endswith(("#0", "#1")) for i in found) == 2


# --- streams of tables -----------------------------------------------------------


NOON = dt.datetime(2024, 1, 31, 12)


def at(minutes):
    return NOON + dt.timedelta(minutes=minutes)


class Inbox:
    """Three folders that streams read, and the decisions written so far."""

    def __init__(self, spark):
        self.spark, self.path, self.out = spark, new_path(spark, "streams"), new_path(spark, "streams-out")
        docs = [(f"r{i}", g.request([g.account(number=f"{i}{k}") for k in range(2)], enq=g.enquiries(0, 5))) for i in range(4)]
        raw = spark.createDataFrame(docs, "request_id string, value string")
        self.tables = dict(zip(("requests", "accounts", "enquiries"), ledger.tables_from_requests(parse_requests(raw), AS_OF)))
        self.tables["enquiries"] = self.tables["enquiries"].withColumn("event_id", F.col("raw.seq"))
        self.want = {r.request_id: r for r in decide_tables(*self.tables.values(), AS_OF).collect()}
        for kind in self.tables:
            self.send(kind, "false", 0)

    def send(self, kind, condition, minutes):
        rows = self.tables[kind].where(condition).withColumn("arrived", F.lit(at(minutes)))
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/{kind}")

    def decide(self):
        read = {}
        for kind, df in self.tables.items():
            schema = df.withColumn("arrived", F.lit(NOON)).schema
            read[kind] = self.spark.readStream.schema(schema).parquet(f"{self.path}/{kind}")
        found = decide_table_streams(**read, as_of=AS_OF, cfg=CURRENT, delay="30 minutes", gap="60 minutes")
        writer = found.writeStream.format("parquet").option("path", f"{self.out}/rows")
        writer.option("checkpointLocation", f"{self.out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        return {r.request_id: r for r in self.spark.read.schema(found.schema).parquet(f"{self.out}/rows").collect()}


def test_a_request_waits_for_its_rows(spark):
    box = Inbox(spark)
    box.send("accounts", "request_id = 'r0'", 0)  # before their request
    box.send("requests", "request_id IN ('r0', 'r1')", 10)
    assert box.decide() == {}
    box.send("accounts", "request_id = 'r0'", 20)  # sent again
    box.send("enquiries", "request_id IN ('r0', 'r1')", 25)
    box.send("accounts", "request_id IN ('r1', 'r3')", 40)  # r3 never has a request
    assert box.decide() == {}
    box.send("requests", "request_id = 'r2'", 200)
    got = box.decide()
    assert got == {i: box.want[i] for i in ("r0", "r1")}
    box.send("accounts", "request_id = 'r2'", 210)
    box.send("enquiries", "request_id = 'r2'", 190)
    box.send("accounts", "request_id = 'r0'", 30)  # too late for any session
    box.send("requests", "request_id = 'r3'", 900)
    got = box.decide()
    assert got == {i: box.want[i] for i in ("r0", "r1", "r2")}
