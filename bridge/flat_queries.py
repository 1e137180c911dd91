"""Registered queries over the flat tables (orders as accounts)."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from bridge import flat_sql as q
from bridge import shapes as sh
from bridge import tables as t
from bridge.expected import ASSET_CODES, PAYMENT_CODES, SUIT_CODES
from bridge.registry import query
from bridge.shapes import AS_OF
from tradeline import config as cfgs
from tradeline import schemas as s
from tradeline.functions import dates, history, limits, numbers
from tradeline.functions.codes import code_level, code_levels
from tradeline.operators import accounts as acc
from tradeline.operators import policy
from tradeline.plans import ledger, monthly
from tradeline.session import new_path
from tradeline.sources import flat
from tradeline.streaming.tables import decide_table_streams

CFG = cfgs.CURRENT


def joined(values: Column) -> Column:
    """Array as text; ``~`` stands for null."""
    return F.array_join(values.cast("array<string>"), ",", "~")


# --- codes ------------------------------------------------------------------


def _code_query(name: str, table: dict[str, int], extra: list[str | None]) -> None:
    """Every code of a table, and unknown ones, on every order and month."""
    codes = [*table, *extra]
    n = len(codes)
    literal = ", ".join("NULL" if c is None else f"'{c}'" for c in codes)
    sql = q.with_ctes(
        f"c AS (SELECT o_orderkey AS acct_number, unnest(generate_series(0, 47)) AS i FROM orders)",
        f"d AS (SELECT *, ([{literal}])[CAST((acct_number * 7 + i) % {n} AS INTEGER) + 1] AS code FROM c)",
        body=f"SELECT acct_number, string_agg(coalesce(CAST({sh.coded('code', table)} AS VARCHAR), '~'), ',' "
        "ORDER BY i) AS levels FROM d GROUP BY acct_number",
    )

    @query(name, sql)
    def run(spark, sf):
        orders = t.spread(t.read(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
        raw = F.expr(
            f"transform(sequence(0, 47), i -> get(array({literal}), CAST((o_orderkey * 7 + i) % {n} AS INT)))"
        )
        return orders.select(
            F.col("o_orderkey").alias("acct_number"), joined(code_levels(raw, table)).alias("levels")
        )


_code_query("code_payment", PAYMENT_CODES, ["*", "ZZZ", "0", "-16", None])
_code_query("code_suit", SUIT_CODES, ["ZZZ", "-1", "ns", None])
_code_query("code_asset", ASSET_CODES, ["*", "-1", "SMA 3", None])


@query(
    "dpd_current",
    q.with_ctes(q.ACCT, q.CELL, body="SELECT acct AS acct_number, payment AS status, p AS dpd FROM level WHERE i = 0"),
)
def dpd_current(spark, sf):
    status = F.get(F.col("payment"), F.lit(0))
    return t.accounts(spark, sf).select(
        "acct_number", status.alias("status"), code_level(status, CFG.payment_codes).alias("dpd")
    )


# --- histories --------------------------------------------------------------


@query(
    "history_pad",
    q.with_ctes(
        q.ACCT, q.CELL,
        "slot AS (SELECT acct, unnest(generate_series(0, 48)) AS i FROM acct)",
        body="SELECT s.acct AS acct_number, string_agg(coalesce(c.payment, '~'), ',' ORDER BY s.i) AS payment, "
        "string_agg(coalesce(c.suit, '~'), ',' ORDER BY s.i) AS suit, "
        "string_agg(coalesce(c.asset, '~'), ',' ORDER BY s.i) AS asset "
        "FROM slot s LEFT JOIN cell c ON c.acct = s.acct AND c.i = s.i GROUP BY s.acct",
    ),
)
def history_pad(spark, sf):
    series = ("payment", "suit", "asset")
    return t.accounts(spark, sf).select(
        "acct_number", *[joined(history.pad(F.col(c))).alias(c) for c in series]
    )


@query(
    "history_reanchor",
    q.with_ctes(
        q.ACCT, q.CELL,
        "slot AS (SELECT acct, lag, unnest(generate_series(0, 48)) AS k FROM acct)",
        body="SELECT s.acct AS acct_number, CAST(any_value(s.lag) AS INTEGER) AS lag, "
        "string_agg(coalesce(CAST(c.p AS VARCHAR), '~'), ',' ORDER BY s.k) AS acctst, "
        "string_agg(coalesce(CAST(c.s AS VARCHAR), '~'), ',' ORDER BY s.k) AS suitst, "
        "string_agg(coalesce(CAST(c.a AS VARCHAR), '~'), ',' ORDER BY s.k) AS assetst "
        "FROM slot s LEFT JOIN level c ON c.acct = s.acct AND c.k = s.k AND c.lag <= 48 AND c.k <= 47 "
        "GROUP BY s.acct",
    ),
)
def history_reanchor(spark, sf):
    df = t.accounts(spark, sf).withColumn("lag", dates.months_ago(F.col("reported"), AS_OF))

    def named(series: str, table) -> Column:
        return joined(history.reanchor(code_levels(F.col(series), table), F.col("lag")))

    return df.select(
        "acct_number", "lag",
        named("payment", CFG.payment_codes).alias("acctst"),
        named("suit", CFG.suit_codes).alias("suitst"),
        named("asset", CFG.asset_codes).alias("assetst"),
    )


@query(
    "avail_split_union",
    q.with_ctes(
        q.ACCT,
        body="SELECT acct AS acct_number, lag, 'available' AS part FROM acct WHERE lag <= 48 "
        "UNION ALL SELECT acct, lag, 'unavailable' FROM acct WHERE lag > 48",
    ),
)
def avail_split_union(spark, sf):
    # One scan: the two parts differ by a label, not by a separate read.
    lag = dates.months_ago(F.col("reported"), AS_OF).cast("bigint")
    parts = acc.availability(F.col("lag"))
    return (
        t.accounts(spark, sf).select("acct_number", lag.alias("lag"))
        .withColumn("part", parts).where(F.col("part").isNotNull())
    )


# --- dates and numbers ------------------------------------------------------


@query("month_lag", q.with_ctes(q.ACCT, body="SELECT acct AS acct_number, CAST(lag AS INTEGER) AS non_avail_per FROM acct"))
def month_lag(spark, sf):
    lag = dates.months_ago(F.col("reported"), AS_OF)
    return t.accounts(spark, sf).select("acct_number", lag.alias("non_avail_per"))


@query("months_on_book", q.with_ctes(q.ACCT, body="SELECT acct AS acct_number, CAST(mob AS INTEGER) AS acct_mob FROM acct"))
def months_on_book(spark, sf):
    mob = dates.months_ago(F.col("opened"), AS_OF)
    return t.accounts(spark, sf).select("acct_number", mob.alias("acct_mob"))


_TENURE = "(year({0}) * 12 + month({0}) - (year(opened) * 12 - month(opened)))"


@query(
    "tenure",
    q.with_ctes(
        q.ACCT,
        f"ten AS (SELECT acct AS acct_number, {_TENURE.format('closed')} AS tenure_clo_ope, "
        f"{_TENURE.format('reported')} AS tenure_rep_ope FROM acct)",
        body="SELECT acct_number, CAST(tenure_clo_ope AS INTEGER) AS tenure_clo_ope, "
        "CAST(tenure_rep_ope AS INTEGER) AS tenure_rep_ope, "
        "CAST(coalesce(tenure_clo_ope, tenure_rep_ope) AS INTEGER) AS tenure_avai FROM ten",
    ),
)
def tenure(spark, sf):
    by_close = dates.tenure_months(F.col("closed"), F.col("opened"))
    by_report = dates.tenure_months(F.col("reported"), F.col("opened"))
    return t.accounts(spark, sf).select(
        "acct_number", by_close.alias("tenure_clo_ope"), by_report.alias("tenure_rep_ope"),
        F.coalesce(by_close, by_report).alias("tenure_avai"),
    )


# Order dates written in ten spellings; the last three cannot be read.
_SPELLINGS = [
    ("yyyy-MM-dd", "%Y-%m-%d"), ("dd-MM-yyyy", "%d-%m-%Y"), ("dd/MM/yyyy", "%d/%m/%Y"),
    ("MM-dd-yyyy", "%m-%d-%Y"), ("MM/dd/yyyy", "%m/%d/%Y"), ("yyyyMMdd", "%Y%m%d"),
    ("yyyy/MM/dd", "%Y/%m/%d"),
]
_SPARK_TEXT = (
    "CASE o_orderkey % 10 "
    + " ".join(f"WHEN {i} THEN date_format(o_orderdate, '{p}')" for i, (p, _) in enumerate(_SPELLINGS))
    + " WHEN 7 THEN 'unknown' WHEN 8 THEN '31-31-2020' ELSE NULL END"
)
_DUCK_TEXT = (
    "CASE o_orderkey % 10 "
    + " ".join(f"WHEN {i} THEN strftime(o_orderdate, '{p}')" for i, (_, p) in enumerate(_SPELLINGS))
    + " WHEN 7 THEN 'unknown' WHEN 8 THEN '31-31-2020' ELSE NULL END"
)


def _read_date_sql(day_first: bool) -> str:
    first_is_day = "a > 12 OR b <= 12" if day_first else "a > 12"
    return q.with_ctes(
        f"x AS (SELECT o_orderkey, {_DUCK_TEXT} AS text, o_orderkey % 10 AS style, o_orderdate FROM orders)",
        "y AS (SELECT *, CASE WHEN style IN (1, 2, 3, 4) THEN CAST(text[1:2] AS INTEGER) END AS a, "
        "CASE WHEN style IN (1, 2, 3, 4) THEN CAST(text[4:5] AS INTEGER) END AS b FROM x)",
        body="SELECT o_orderkey, text, CASE WHEN style IN (0, 5, 6) THEN strftime(o_orderdate, '%Y-%m-%d') "
        f"WHEN style IN (1, 2, 3, 4) THEN text[7:10] || '-' || lpad(CAST(CASE WHEN {first_is_day} THEN b ELSE a END AS VARCHAR), 2, '0') "
        f"|| '-' || lpad(CAST(CASE WHEN {first_is_day} THEN a ELSE b END AS VARCHAR), 2, '0') END AS day FROM y",
    )


def _read_dates(spark, sf, day_first: bool):
    df = t.read(spark, sf, "orders").select("o_orderkey", F.expr(_SPARK_TEXT).alias("text"))
    day = dates.parse_date(F.col("text"), AS_OF, day_first)
    return df.select("o_orderkey", "text", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query("parse_date_dayfirst", _read_date_sql(True))
def parse_date_dayfirst(spark, sf):
    return _read_dates(spark, sf, True)


@query("parse_date_monthfirst", _read_date_sql(False))
def parse_date_monthfirst(spark, sf):
    return _read_dates(spark, sf, False)


@query(
    "scalar_date_format",
    q.with_ctes(
        q.ACCT, q.ENQ,
        body="SELECT 'account' AS kind, acct AS id, strftime(opened, '%Y-%m-%d %H:%M:%S') AS opened, "
        "strftime(closed, '%Y-%m-%d %H:%M:%S') AS closed, strftime(reported, '%Y-%m-%d %H:%M:%S') AS reported FROM acct "
        "UNION ALL SELECT 'enquiry', event_id, NULL, NULL, strftime(date, '%Y-%m-%d %H:%M:%S') FROM enq",
    ),
)
def scalar_date_format(spark, sf):
    none = F.lit(None).cast("string")
    accounts = t.accounts(spark, sf).select(
        F.lit("account").alias("kind"), F.col("acct_number").alias("id"),
        *[dates.date_text(F.col(c)).alias(c) for c in ("opened", "closed", "reported")],
    )
    return accounts.unionByName(
        t.enquiries(spark, sf).select(
            F.lit("enquiry").alias("kind"), F.col("event_id").alias("id"), none.alias("opened"),
            none.alias("closed"), dates.date_text(F.col("date")).alias("reported"),
        )
    )


_NUMBER_TEXT = (
    "CASE o_orderkey % 8 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '1e3' WHEN 3 THEN NULL "
    "WHEN 4 THEN concat(' ', CAST(o_orderkey AS {s}), ' ') WHEN 5 THEN concat(CAST(o_orderkey AS {s}), 'd') "
    "WHEN 6 THEN 'nan' ELSE concat('-', CAST(o_orderkey AS {s}), '.25') END"
)


@query(
    "numeric_cast",
    q.with_ctes(
        f"x AS (SELECT o_orderkey, o_orderkey % 8 AS style, {_NUMBER_TEXT.format(s='VARCHAR')} AS text FROM orders)",
        body="SELECT o_orderkey, text, CASE style WHEN 2 THEN CAST(1000 AS DOUBLE) WHEN 4 THEN CAST(o_orderkey AS DOUBLE) "
        "WHEN 7 THEN -(o_orderkey + CAST(0.25 AS DOUBLE)) END AS amount, style IN (0, 1, 5) AS bad, "
        "CASE WHEN style = 4 THEN o_orderkey END AS whole FROM x",
    ),
)
def numeric_cast(spark, sf):
    df = t.read(spark, sf, "orders").selectExpr("o_orderkey", f"{_NUMBER_TEXT.format(s='STRING')} AS text")
    text = F.col("text")
    return df.select(
        "o_orderkey", "text", numbers.to_amount(text).alias("amount"),
        numbers.is_bad_number(text).alias("bad"), numbers.to_whole(text).alias("whole"),
    )


# --- account features -------------------------------------------------------


def _flag_query(name: str, columns: list[str], counts: bool = False) -> None:
    picked = ", ".join(f"CAST({c} AS INTEGER) AS {c}" if counts else c for c in columns)
    sql = q.with_ctes(q.ACCT, q.CELL, q.FLAG, body=f"SELECT acct AS acct_number, {picked} FROM flag")

    @query(name, sql)
    def run(spark, sf):
        return acc.score_accounts(t.accounts(spark, sf), AS_OF, CFG).select("acct_number", *columns)


_flag_query("feat_perf_avail", ["perf_avail"])
_flag_query("feat_derog", ["derog_pol"])
_flag_query("feat_overdue", ["act_acct_pol"])
_flag_query("feat_dpd_ever", ["dpd90_pol_l12m", "dpd60_pol_l12m", "dpd30_pol_l6m", "dpd30_pol_l12m"])
_flag_query("feat_dpd_count", ["dpd30_pol_l12m_cnt", "dpd30_pol_l6m_cnt", "dpd30_pol_l3m_cnt"], counts=True)


@query(
    "feat_score",
    q.with_ctes(q.REQ, body="SELECT request_id, coalesce(score, 99999) AS score, coalesce(score, 99999) >= 700 AS sco_pol FROM req"),
)
def feat_score(spark, sf):
    score = policy.known_score(F.col("score"), CFG)
    return t.requests(spark, sf).select(
        "request_id", score.alias("score"), policy.score_passes(score, CFG).alias("sco_pol")
    )


@query(
    "feat_long_form",
    q.with_ctes(
        q.ACCT, q.CELL, q.FLAG,
        body="SELECT a.request_id, acct AS acct_number, worst_p, worst_12, coalesce(n12, 0) AS n12, "
        "coalesce(n6, 0) AS n6, coalesce(n3, 0) AS n3 FROM acct a JOIN seen USING (acct)",
    ),
)
def feat_long_form(spark, sf):
    """Cross-check of the array frames: one row per visible month, then a group-by."""
    df = t.accounts(spark, sf).withColumn("lag", dates.months_ago(F.col("reported"), AS_OF))
    months = df.select(
        "request_id", "acct_number", F.inline_outer(history.long_form(F.col("payment"), F.col("lag")))
    ).where(F.col("k").isNotNull())
    p, k = code_level(F.col("code"), CFG.payment_codes), F.col("k")
    late = lambda m: F.count_if(k.between(1, m) & (F.col("p") >= CFG.dpd30))
    return (
        months.withColumn("p", p)
        .groupBy("request_id", "acct_number")
        .agg(
            F.max("p").alias("worst_p"),
            F.max(F.when(k.between(1, 12), F.col("p"))).alias("worst_12"),
            late(12).alias("n12"), late(6).alias("n6"), late(3).alias("n3"),
        )
    )


@query(
    "filter_open_date",
    q.with_ctes(q.ACCT, body="SELECT request_id, acct AS acct_number, strftime(opened, '%Y-%m-%d') AS opened FROM acct WHERE opened IS NOT NULL"),
)
def filter_open_date(spark, sf):
    return t.accounts(spark, sf).where(acc.opened_known(F.col)).select(
        "request_id", "acct_number", F.date_format("opened", "yyyy-MM-dd").alias("opened")
    )


# --- report-wide fallbacks --------------------------------------------------


@query(
    "coalesce_highcredit",
    q.with_ctes(
        q.ACCT,
        body="SELECT request_id, acct AS acct_number, CASE WHEN bool_or(highcredit IS NOT NULL OR sanctionamount IS NOT NULL) "
        "OVER (PARTITION BY request_id) THEN coalesce(highcredit, sanctionamount) ELSE creditlimit END AS highcredit FROM acct",
    ),
)
def coalesce_highcredit(spark, sf):
    return ledger.with_highcredit(t.accounts(spark, sf)).select("request_id", "acct_number", "highcredit")


@query(
    "coalesce_suitfiled",
    q.with_ctes(
        q.ACCT,
        body=f"SELECT request_id, acct AS acct_number, CASE WHEN bool_or(suit_status IS NOT NULL) OVER (PARTITION BY request_id) "
        f"THEN suit_status ELSE {sh.suit('acct', '0')} END AS suitfiledstatus FROM acct",
    ),
)
def coalesce_suitfiled(spark, sf):
    return ledger.with_suit_filed(t.accounts(spark, sf), CFG).select("request_id", "acct_number", "suitfiledstatus")


# --- requests ---------------------------------------------------------------


@query(
    "thin_file",
    q.with_ctes(
        q.ACCT,
        body="SELECT request_id, count(*) AS n_rows, CAST(max(mob) AS INTEGER) AS max_mob, "
        "coalesce(max(mob) < 6, true) AND count(*) <= 1 AS thin FROM acct GROUP BY request_id",
    ),
)
def thin_file(spark, sf):
    facts = ledger.account_facts(t.accounts(spark, sf), AS_OF, CFG).select(
        "request_id", F.col("n_accounts").alias("n_rows"), "max_mob"
    )
    return facts.withColumn("thin", policy.is_thin_file(F.col("max_mob"), F.col("n_rows"), CFG))


@query(
    "enquiry_flag",
    q.with_ctes(
        q.ENQ,
        body=f"SELECT event_id, strftime(date, '%Y-%m-%d') AS date, coalesce({q.months_to('date')} <= 3, false) AS inq_flag FROM enq",
    ),
)
def enquiry_flag(spark, sf):
    return t.enquiries(spark, sf).select(
        "event_id", F.date_format("date", "yyyy-MM-dd").alias("date"),
        policy.is_recent_enquiry(F.col("date"), AS_OF, CFG).alias("inq_flag"),
    )


@query("enquiry_count", q.with_ctes(q.ENQ, body="SELECT request_id, n AS inq_flag FROM enq_count"))
def enquiry_count(spark, sf):
    return ledger.enquiry_counts(t.enquiries(spark, sf), AS_OF, CFG)


@query(
    "join_enquiry_counts",
    q.with_ctes(q.REQ, q.ENQ, body="SELECT request_id, reportnumber, coalesce(n, 0) AS inq_flag FROM req LEFT JOIN enq_count USING (request_id)"),
)
def join_enquiry_counts(spark, sf):
    counts = ledger.enquiry_counts(t.enquiries(spark, sf), AS_OF, CFG)
    return t.requests(spark, sf).select("request_id", "reportnumber").join(
        counts, "request_id", "left"
    ).withColumn("inq_flag", F.coalesce("inq_flag", F.lit(0)))


def _policy_rows(spark, sf):
    return ledger.policy_table(
        t.requests(spark, sf), t.accounts(spark, sf), t.enquiries(spark, sf), AS_OF, CFG
    )


_METRICS = [n for n, _ in s.METRIC_FIELDS]


@query(
    "agg_user_policy",
    q.with_ctes(
        q.REQ, q.ACCT, q.CELL, q.FLAG, q.ENQ, q.METRIC,
        body=f"SELECT request_id, reportnumber, {', '.join(_METRICS)} FROM ruled WHERE route = 'HIT' AND n_usable > 0",
    ),
)
def agg_user_policy(spark, sf):
    return ledger.user_policy_rows(_policy_rows(spark, sf)).select("request_id", "reportnumber", *_METRICS)


@query(
    "rules_user_policy",
    q.with_ctes(
        q.REQ, q.ACCT, q.CELL, q.FLAG, q.ENQ, q.METRIC,
        body=f"SELECT request_id, {', '.join(q.RULES)}, {' AND '.join(q.RULES)} AS accepted FROM ruled "
        "WHERE route = 'HIT' AND n_usable > 0",
    ),
)
def rules_user_policy(spark, sf):
    rows = ledger.user_policy_rows(_policy_rows(spark, sf))
    return rows.select("request_id", *s.RULE_NAMES, policy.all_pass(F.col, CFG).alias("accepted"))


def _decision_sql(*, metric=q.METRIC, enq=q.ENQ, limit=(q.GRID, q.limited("ruled")), undated="true", extra="") -> str:
    """SELECT for the decision table; ``limit`` is None for a policy without one."""
    ctes = limit or ("limited AS (SELECT *, CAST(NULL AS BIGINT) AS bnpl_limit FROM ruled)",)
    return q.with_ctes(
        q.REQ, q.ACCT, q.CELL, q.FLAG, enq, metric, *ctes,
        body=f"""SELECT {extra}request_id,
  CASE WHEN bad THEN NULL WHEN route = 'INVALID' THEN NULL WHEN route = 'NOHIT' THEN 'True' WHEN n_usable = 0 THEN '0'
       WHEN {' AND '.join(q.RULES)} THEN 'True' ELSE 'False' END AS accept_ind,
  CASE WHEN bad THEN NULL WHEN route = 'INVALID' THEN 'NA' WHEN route = 'NOHIT' THEN 'NTC'
       WHEN n_accounts <= 1 AND coalesce(max_mob < 6, {undated}) THEN 'NTC' ELSE 'ETC' END AS bureau_history_status,
  CASE WHEN bad THEN NULL ELSE bnpl_limit END AS bnpl_limit,
  CASE WHEN bad THEN 'MISSING_HISTORY' END AS error_reason
FROM (SELECT *, route = 'HIT' AND n_accounts IS NULL AS bad FROM limited)""",
    )


def _tables(spark, sf):
    return t.requests(spark, sf), t.accounts(spark, sf), t.enquiries(spark, sf)


@query("decision_table", _decision_sql())
def decision_table(spark, sf):
    return ledger.decide_tables(*_tables(spark, sf), AS_OF, CFG).drop("user_id")


#: The usual decision date, up to three months later by request.
OWN_DATE = "add_months(DATE '2024-01-31', CAST({k} AS INT) % 4)"


@query("decision_dated_table", q.decided_later(_decision_sql(), "request_id % 4"))
def decision_dated_table(spark, sf):
    """Every request has a decision date of its own."""
    requests, accounts, enquiries = _tables(spark, sf)
    requests = requests.withColumn("as_of", F.expr(OWN_DATE.format(k="request_id")))
    accounts, enquiries = (ledger.with_dates(rows, requests) for rows in (accounts, enquiries))
    return ledger.decide_tables(requests, accounts, enquiries, F.col("as_of"), CFG).drop("user_id")


#: Rows of a bucket or file at most, so that a task holds as much whatever the tables hold.
PART_ROWS = 250_000


@query("decision_bucketed", _decision_sql())
def decision_bucketed(spark, sf):
    """The tables lie by request, so nothing is shuffled for the decision."""
    name, path = f"flat_{uuid.uuid4().hex}", new_path(spark, "bucketed")
    tables = _tables(spark, sf)
    buckets = t.parts_of(max(df.count() for df in tables), PART_ROWS, 8)
    flat.write_flat_tables(tables, name, path, buckets=buckets)
    return ledger.decide_tables(*flat.read_flat_tables(spark, name), AS_OF, CFG).drop("user_id")


@query("stream_tables", _decision_sql())
def stream_tables(spark, sf):
    """Three streams of files; rows come in any order, and some twice."""
    inbox, out = new_path(spark, "flat-inbox"), new_path(spark, "flat-stream")
    keys = {"requests": "request_id", "accounts": "acct_number", "enquiries": "event_id"}
    tables = dict(zip(keys, _tables(spark, sf), strict=True))
    came = "TIMESTAMP '2024-01-31 10:00:00' + make_dt_interval(0, 0, CAST(request_id % 40 + {key} % 20 AS INT))"
    streams = {}
    for kind, df in tables.items():
        df = df.withColumn("arrived", F.expr(came.format(key=keys[kind])))
        df = df.unionByName(df.where(f"{keys[kind]} % 7 = 0"))
        # Three files, or three times as many; two thirds of them make a batch.
        thirds = t.parts_of(df.count(), 3 * PART_ROWS, 1)
        df.repartition(3 * thirds, F.hash(keys[kind])).write.parquet(f"{inbox}/{kind}")
        streams[kind] = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2 * thirds).parquet(f"{inbox}/{kind}")
    # What comes two days later closes all sessions before it, and stays open itself.
    late = tables["requests"].limit(1).withColumns({"request_id": F.lit(-1).cast("bigint"), "arrived": F.expr("TIMESTAMP '2024-02-02 10:00:00'")})
    decisions = decide_table_streams(**streams, as_of=AS_OF, cfg=CFG, delay="2 hours", gap="2 hours")
    for more in (None, late):
        if more is not None:
            more.write.mode("append").parquet(f"{inbox}/requests")
        writer = decisions.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(decisions.schema).parquet(f"{out}/rows").drop("user_id")


# A stricter policy: other limits and grids, a higher score, a longer memory of enquiries, no overdue account.
STRICT_RULES = tuple(dataclasses.replace(r, limit=0) if r.name == "cnt_overdue_accts_dec" else r for r in CFG.rules)


def strict(other):
    return dataclasses.replace(other, min_score=760, enquiry_months=5, rules=STRICT_RULES)


STRICT_METRIC = q.METRIC.replace(">= 700", ">= 760").replace("cnt_overdue_accts <= 1", "cnt_overdue_accts <= 0")


def strict_enquiries(enq: str) -> str:
    return enq.replace("<= 3, false", "<= 5, false")


def side_by_side(**selects: str) -> str:
    """The rows of several SELECTs with the name of each."""
    return " UNION ALL ".join(f"SELECT '{name}' AS policy_name, * FROM ({sql}) AS {name}_rows" for name, sql in selects.items())


def _later_sql(months: int) -> str:
    columns = f"CAST({months} AS INTEGER) AS months, request_id, reportnumber, {', '.join(_METRICS)}"
    sql = q.with_ctes(
        q.REQ, q.ACCT, q.CELL, q.FLAG, q.ENQ, q.METRIC,
        body=f"SELECT {columns} FROM ruled WHERE route = 'HIT' AND n_usable > 0",
    )
    return f"SELECT * FROM ({q.decided_later(sql, str(months))}) AS m{months}"


@query("metrics_merged", " UNION ALL ".join(map(_later_sql, (0, 7, 40))))
def metrics_merged(spark, sf):
    """Two deliveries, one of them sent twice, folded as of three dates."""
    path = new_path(spark, "changes")
    accounts, enquiries = t.accounts(spark, sf), t.enquiries(spark, sf)
    for delivery, part in (("a", 0), ("b", 1), ("a", 0)):
        own = monthly.account_changes(accounts.where(f"acct_number % 2 = {part}"), CFG)
        own = own.unionByName(monthly.enquiry_changes(enquiries.where(f"event_id % 2 = {part}"), CFG))
        monthly.save_delivery(own, path, delivery)
    changes = monthly.read_deliveries(spark, path)
    parts = []
    for months, as_of in ((0, AS_OF), (7, dt.date(2024, 8, 31)), (40, dt.date(2027, 5, 31))):
        joined = t.requests(spark, sf).join(monthly.facts_at(changes, as_of), "request_id", "left")
        rows = ledger.user_policy_rows(ledger.ruled(joined, CFG))
        parts.append(rows.select(F.lit(months).alias("months"), "request_id", "reportnumber", *_METRICS))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- limits -----------------------------------------------------------------


def _bands(df):
    return df.withColumns(
        {
            "score_band": limits.score_band(F.col("limit_score")),
            "income_band": limits.income_band(F.col("min_income"), F.col("max_income")),
        }
    )


@query("score_band", q.with_ctes(q.REQ, body=f"SELECT request_id, limit_score, {q.score_band('limit_score')} AS score_band FROM req"))
def score_band(spark, sf):
    return _bands(t.requests(spark, sf)).select("request_id", "limit_score", "score_band")


@query(
    "income_band",
    q.with_ctes(q.REQ, body=f"SELECT request_id, min_income, max_income, {q.income_band('min_income', 'max_income')} AS income_band FROM req"),
)
def income_band(spark, sf):
    return _bands(t.requests(spark, sf)).select("request_id", "min_income", "max_income", "income_band")


_GRID_SQL = q.with_ctes(
    q.REQ, q.GRID, q.limited("req"),
    body="SELECT request_id, score_band, income_band, multiplier, max_cap, min_cap FROM limited",
)


@query("limit_grid_lookup", _GRID_SQL)
def limit_grid_lookup(spark, sf):
    band, income = F.col("score_band"), F.col("income_band")
    return _bands(t.requests(spark, sf)).select(
        "request_id", "score_band", "income_band",
        limits.grid_value(CFG.limit_multiplier, band, income).alias("multiplier"),
        limits.grid_value(CFG.limit_ceiling, band, income).alias("max_cap"),
        limits.grid_value(CFG.limit_floor, band, income).alias("min_cap"),
    )


@query("join_limit_grid", _GRID_SQL)
def join_limit_grid(spark, sf):
    return limits.with_grid(_bands(t.requests(spark, sf)), limits.grid_frame(spark)).select(
        "request_id", "score_band", "income_band", "multiplier", "max_cap", "min_cap"
    )


@query("limit_calculation", q.with_ctes(q.REQ, q.GRID, q.limited("req"), body="SELECT request_id, base_limit, CASE WHEN request_id % 9 <> 0 THEN bnpl_limit END AS bnpl_limit FROM limited"))
def limit_calculation(spark, sf):
    """Every ninth request comes without a score, so it has no limit."""
    score = F.when(F.col("request_id") % 9 != 0, F.col("limit_score"))
    limit = limits.credit_limit(F.col("base_limit"), score, F.col("min_income"), F.col("max_income"))
    return t.requests(spark, sf).select("request_id", "base_limit", limit.alias("bnpl_limit"))


# Another policy: five bands, other brackets and grids, limits in steps of 50.
OTHER_BANDS = (("P", 850), ("Q", 650), ("R", 450), ("S", 250))
OTHER_BRACKETS = ((0, 10000, 1), (10000, 25000, 2), (50000, None, 3))
OTHER_GRIDS = {
    "limit_multiplier": {"P": (1.2, 1.4, 1.6), "Q": (1.0, 1.1, 1.2), "R": (0.9, 0.9, 1.0), "S": (0.7, 0.7, 0.8), "T": (0.5, 0.5, 0.5)},
    "limit_ceiling": {"P": (2000, 3000, 5000), "Q": (1500, 2500, 4000), "R": (1000, 1500, 2000), "S": (600, 700, 800), "T": (250, 250, 250)},
    "limit_floor": {"P": (400, 500, 600), "Q": (300, 400, 500), "R": (250, 250, 250), "S": (150, 150, 150), "T": (50, 50, 50)},
}
OTHER = dataclasses.replace(
    CFG, score_bands=OTHER_BANDS, lowest_band="T", income_brackets=OTHER_BRACKETS, limit_step=50, **OTHER_GRIDS
)


@query(
    "limit_other_policy",
    q.with_ctes(
        q.REQ, q.grid(*OTHER_GRIDS.values()),
        q.limited("req", q.score_band("limit_score", OTHER_BANDS, "T"), q.income_band("min_income", "max_income", OTHER_BRACKETS), 50),
        body="SELECT request_id, score_band, income_band, multiplier, bnpl_limit FROM limited",
    ),
)
def limit_other_policy(spark, sf):
    """Bands, brackets, grids and step are policy data."""
    score, low, high = F.col("limit_score"), F.col("min_income"), F.col("max_income")
    rows = t.requests(spark, sf).withColumns(
        {
            "score_band": limits.score_band(score, OTHER),
            "income_band": limits.income_band(low, high, cfg=OTHER),
            "bnpl_limit": limits.credit_limit(F.col("base_limit"), score, low, high, cfg=OTHER),
        }
    )
    rows = limits.with_grid(rows, limits.grid_frame(spark, OTHER))
    return rows.select("request_id", "score_band", "income_band", "multiplier", "bnpl_limit")


_STRICT_LIMIT = (
    q.grid(*OTHER_GRIDS.values()),
    q.limited("ruled", q.score_band("limit_score", OTHER_BANDS, "T"), q.income_band("min_income", "max_income", OTHER_BRACKETS), 50),
)


@query(
    "decision_policies_table",
    side_by_side(
        current=_decision_sql(),
        launch=_decision_sql(limit=None, undated="false"),
        strict=_decision_sql(metric=STRICT_METRIC, enq=strict_enquiries(q.ENQ), limit=_STRICT_LIMIT),
    ),
)
def decision_policies_table(spark, sf):
    """Three policies in one pass over the tables."""
    policies = {"current": CFG, "launch": cfgs.LAUNCH, "strict": strict(OTHER)}
    return ledger.decide_policies_tables(*_tables(spark, sf), AS_OF, policies).drop("user_id")
