"""Decisions from three streams: requests, accounts and enquiries that arrive as tables of their own.

Every account becomes a row of what it adds to the metrics, every enquiry a row that is recent or not, every
request a row that carries itself. The three are one stream, in which a request's rows form a session: it ends when
none of them has come for ``gap``, and is decided when the watermark has passed that. So a request is held until
its accounts and enquiries are there, in any order. All aggregates are sums, maxima and any, which Spark combines
before the shuffle; the state holds one row for each open request and one key for each recent row.

A row that is sent again is dropped by its key (within ``delay``). Rows later than ``delay`` behind the newest one, and rows
whose request doesn't come within their session, have no decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf
from tradeline.operators import accounts as acc
from tradeline.operators import policy
from tradeline.plans import ledger

_NOTHING = {"sum": "CAST(0 AS BIGINT)", "max": "CAST(NULL AS INT)", "any": "false"}


def decide_table_streams(
    requests: DataFrame,
    accounts: DataFrame,
    enquiries: DataFrame,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
    *,
    time: str = "arrived",
    delay: str = "1 hour",
    gap: str = "1 hour",
    account_key: str = "acct_number",
    enquiry_key: str = "event_id",
) -> DataFrame:
    """Decision table as a stream in append mode; the inputs are those of ``ledger.decide_tables``.

    Each input has the event time ``time``; the keys tell rows of one request apart.
    """
    own = [n for n in requests.columns if n not in ("request_id", time)]
    shape = {name: how for name, (how, _) in acc.contributions(F.col).items()}
    nothing = {name: F.expr(_NOTHING[how]) for name, how in shape.items()} | {"inq_flag": F.expr(_NOTHING["sum"])}
    no_request = F.lit(None).cast(requests.select(F.struct(*own).alias("r")).schema["r"].dataType)

    def rows(df: DataFrame, kind: str, key: Column, values: dict[str, Column], request: Column = no_request) -> DataFrame:
        columns = {**nothing, **values}
        return df.select(
            "request_id", F.col(time).alias("arrived"), F.lit(kind).alias("kind"), key.cast("string").alias("row_key"),
            *[value.alias(name) for name, value in columns.items()], request.alias("request"),
        )

    scored = acc.score_accounts(accounts, as_of, cfg)
    added = {name: value for name, (_, value) in acc.contributions(F.col).items()}
    recent = policy.is_recent_enquiry(F.col("date"), as_of, cfg).cast("bigint")
    both = rows(requests, "request", F.lit(None), {}, F.struct(*own))
    both = both.unionByName(rows(scored, "account", F.col(account_key), added))
    both = both.unionByName(rows(enquiries, "enquiry", F.col(enquiry_key), {"inq_flag": recent}))
    once = both.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["request_id", "kind", "row_key"])
    combine = {"sum": F.sum, "max": F.max, "any": F.bool_or}
    held = once.groupBy("request_id", F.session_window("arrived", gap).alias("session")).agg(
        *[combine[how](name).alias(name) for name, how in shape.items()],
        F.sum("inq_flag").alias("inq_flag"),
        F.first("request", ignorenulls=True).alias("request"),
    )
    complete = held.where("request is not null").select("*", "request.*").drop("request", "session")
    return ledger.decided(ledger.ruled(complete, cfg), as_of, cfg).select(*[n for n, _ in s.DECISION_FIELDS])
