"""What a registered query reads, shuffles and writes follows the tables, not a fixed number of parts."""

import re

import pytest
from pyspark.sql import functions as F

from bridge import document_queries as dq
from bridge import flat_queries as fq
from bridge import shapes as sh
from bridge import tables as t
from bridge.registry import QUERIES
from tests.test_plans import SF, plan_of
from tradeline.session import Files


class Stop(Exception):
    pass


@pytest.fixture
def caught(monkeypatch):
    """Ends a query at the named function; gives what it was called with."""

    def end_at(module, name, query, spark):
        seen = {}

        def stop(*args, **kwargs):
            seen.update(args=args, **kwargs)
            raise Stop

        monkeypatch.setattr(module, name, stop)
        with pytest.raises(Stop):
            QUERIES[query](spark, SF)
        return seen

    return end_at


def files(spark, path):
    return [n for n in Files(spark, path).names(path) if n.startswith("part-")]


def test_a_stream_has_files_by_its_documents(spark, caught):
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        path = caught(dq.src, "stream_requests", "stream_decision", spark)["args"][1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert len(files(spark, path)) == 8


def test_streams_of_tables_have_files_by_their_rows(spark, caught, monkeypatch):
    monkeypatch.setattr(fq, "PART_ROWS", 100)
    streams = caught(fq, "decide_table_streams", "stream_tables", spark)
    for kind, table in (("requests", t.requests), ("accounts", t.accounts)):
        rows = table(spark, SF).count()
        stored = streams[kind]._jdf.queryExecution().analyzed().toString()
        path = stored.split("FileSource[", 1)[1].split("]", 1)[0]
        sent = spark.read.parquet(path).count()
        assert sent > rows and len(files(spark, path)) == 3 * -(-sent // 300)


def test_buckets_follow_the_rows(spark, caught, monkeypatch):
    monkeypatch.setattr(fq, "PART_ROWS", 100)
    largest = max(table(spark, SF).count() for table in (t.requests, t.accounts, t.enquiries))
    assert caught(fq.flat, "write_flat_tables", "decision_bucketed", spark)["buckets"] == -(-largest // 100) > 8


def test_ids_are_compared_without_the_documents(spark):
    plan = plan_of(QUERIES["request_ids"](spark, SF))
    saved = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "user_id#" in saved and "value#" not in saved


def test_request_files_are_opened_once(spark):
    plan = plan_of(QUERIES["src_request_file"](spark, SF))
    assert plan.count("FileScan text") == 1
    assert "raw_" not in plan.split("Exchange", 1)[1].split("\n", 1)[0]


def test_unmarked_accounts_share_their_months(spark):
    """The literal histories hold for every account whose codes no rare condition changes."""
    rows = spark.range(3000).selectExpr("id AS k", "explode(sequence(0, 3)) AS j").selectExpr("k", "k * 5 + j AS a")
    own, shared = t._months("k", "a"), f"CASE WHEN a % 5 = 0 THEN {t._months('1', '5')} ELSE {t._months('1', '1')} END"
    rows = rows.select(F.expr(sh.marked("k", "a")).alias("marked"), F.expr(own).alias("own"), F.expr(shared).alias("shared"))
    counts = rows.groupBy("marked").agg(F.count("*").alias("n"), F.count_if(F.col("own") != F.col("shared")).alias("other")).collect()
    found = {r.marked: (r.n, r.other) for r in counts}
    assert found[False][1] == 0 and found[True][1] > 0 and found[False][0] > 2 * found[True][0]
