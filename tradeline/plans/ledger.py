"""Decision plan over flat tables: requests, accounts and enquiries.

Used when a bureau delivers accounts as their own table. Accounts and enquiries
are combined per request before they are shuffled, so a request that owns a
large share of all accounts is no heavier than any other, and the joins meet one
row per request on each side.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf, per_request
from tradeline.functions.limits import credit_limit
from tradeline.operators import accounts as acc
from tradeline.operators import parse, policy
from tradeline.plans import documents, export


def with_dates(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Account or enquiry rows with the decision date ``as_of`` of their request.

    Only needed for tables that don't carry the date themselves. The dates are one narrow row for each
    request; a request with very many rows is a skewed join, whose rows Spark deals out at run time.
    """
    return rows.join(requests.select("request_id", "as_of"), "request_id", "left")


def enquiry_counts(enquiries: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Recent enquiries per request from an enquiry table (request_id, date)."""
    recent = policy.is_recent_enquiry(F.col("date"), as_of, cfg)
    return enquiries.groupBy("request_id").agg(F.count_if(recent).alias("inq_flag"))


def account_facts(accounts: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Rolled-up account metrics, one row per request."""
    known = {"high_known": _high_known()} if "raw" in accounts.columns else {}
    return acc.roll_up(acc.score_accounts(accounts, as_of, cfg), also=known)


def _high_known() -> Column:
    return F.col("raw.HighCredit").isNotNull() | F.col("raw.SanctionAmount").isNotNull()


def ruled(joined: DataFrame, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Requests beside their account facts and ``inq_flag``, with all metrics and the twelve rule outcomes."""
    rows = joined.withColumns(
        {
            "max_inq_l3m": F.coalesce(F.col("inq_flag"), F.lit(0).cast("bigint")),
            "max_score": acc.holds(policy.score_passes(policy.known_score(F.col("score"), cfg), cfg)),
        }
    ).drop("inq_flag")
    unused = {n: F.lit(None).cast("boolean") for n in s.RULE_NAMES}
    return rows.withColumns({**unused, **policy.rule_outcomes(F.col, cfg)})


def policy_table(
    requests: DataFrame,
    accounts: DataFrame,
    enquiries: DataFrame,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
) -> DataFrame:
    """Requests with their metrics and the twelve rule outcomes.

    ``requests`` carries request_id, reportnumber, route, score (null = none).
    The grouped sides are already partitioned by request, so only the request
    table itself is exchanged for the joins.
    """
    facts = account_facts(accounts, as_of, cfg)
    counts = enquiry_counts(enquiries, as_of, cfg)
    return ruled(requests.join(facts, "request_id", "left").join(counts, "request_id", "left"), cfg)


def decided(rows: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """``ruled`` requests with accept_ind, bureau_history_status, bnpl_limit and error_reason.

    Limit inputs: base_limit, limit_score, min_income, max_income (doubles);
    profiles without a limit need none. ``income_open_ended`` may say that no upper
    income was sent (default: ``max_income`` is null). An optional ``rows_per_account``
    is the number of products or phones of the request (see the thin-file rule).
    """
    c = F.col
    limit = F.lit(None).cast("bigint")
    limit_error = F.lit(None).cast("string")
    if cfg.envelope:
        open_ended = c("income_open_ended") if "income_open_ended" in rows.columns else None
        limit = credit_limit(
            c("base_limit"), c("limit_score"), c("min_income"), c("max_income"), open_ended, cfg
        )
        limit_error = F.when(c("bnpl_limit").isNull(), "BAD_LIMIT_INPUT")
    df = rows.withColumns(
        {
            "n_accounts": F.coalesce("n_accounts", F.lit(0)),
            "n_usable": F.coalesce("n_usable", F.lit(0)),
            "bnpl_limit": limit,
        }
    )
    known_score = policy.known_score(c("score"), cfg)
    get = lambda n: known_score if n == "score" else c(n)
    # Flat tables have no enquiry summary that could be missing.
    reading = policy.report_error(get, replace(cfg, require_enquiry_summary=False))
    undated = [policy.missing_date(as_of)] if per_request(as_of) else []
    df = df.withColumn(
        "error_reason", F.coalesce(*undated, F.when(c("route") == "HIT", reading), limit_error)
    )
    ok = F.col("error_reason").isNull()
    n_rows = c("n_accounts") * (c("rows_per_account") if "rows_per_account" in df.columns else 1)
    thin = policy.is_thin_file(F.col("max_mob"), n_rows, cfg)
    accepted = policy.all_pass(F.col, cfg)
    if "user_id" not in df.columns:
        df = df.withColumn("user_id", F.lit(None).cast("string"))
    return df.withColumns(
        {
            "accept_ind": F.when(
                ok, policy.accept_indicator(F.col("route"), F.col("n_usable"), accepted)
            ),
            "bureau_history_status": F.when(ok, policy.history_status(F.col("route"), thin)),
            "bnpl_limit": F.when(ok, F.col("bnpl_limit")),
        }
    )


def decide_tables(
    requests: DataFrame,
    accounts: DataFrame,
    enquiries: DataFrame,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
) -> DataFrame:
    """Decision table; ``requests`` also carries the limit inputs (see :func:`decided`).

    With a date column, ``as_of`` is a column of all three tables (see :func:`with_dates`).
    """
    rows = decided(policy_table(requests, accounts, enquiries, as_of, cfg), as_of, cfg)
    return rows.select(*[n for n, _ in s.DECISION_FIELDS])


def decide_policies_tables(
    requests: DataFrame,
    accounts: DataFrame,
    enquiries: DataFrame,
    as_of: AsOf,
    policies: Mapping[str, PolicyConfig],
) -> DataFrame:
    """Decisions of several policies: a row for each request and policy.

    Accounts are read once and rolled up by one aggregate that holds the metrics of all policies, so there are as
    many shuffles as for one policy.
    """
    staged, aggregates, counts = acc.with_defaults(accounts), [], []
    for i, cfg in enumerate(policies.values()):
        own: set[str] = set()
        get = lambda n, i=i, own=own: F.col(f"p{i}_{n}") if n in own else F.col(n)
        for stage in acc.STAGES:
            columns = stage(get, cfg, as_of)
            staged = staged.withColumns({f"p{i}_{n}": v for n, v in columns.items()})
            own |= set(columns)
        aggregates += acc.combined(get, f"p{i}_")
        recent = policy.is_recent_enquiry(F.col("date"), as_of, cfg)
        counts.append(F.count_if(recent).alias(f"p{i}_inq_flag"))
    facts = staged.groupBy("request_id").agg(*aggregates)
    joined = requests.join(facts, "request_id", "left").join(
        enquiries.groupBy("request_id").agg(*counts), "request_id", "left"
    )
    fields = [n for n, _ in s.DECISION_FIELDS]
    df, done = joined.select(F.struct(*joined.columns).alias("whole")), []
    for i, (name, cfg) in enumerate(policies.items()):
        prefix = f"p{i}_"
        metrics = [F.col(f"whole.{n}").alias(n.removeprefix(prefix)) for n in joined.columns if n.startswith(prefix)]
        rows = df.select("whole", *done, *[F.col(f"whole.{n}").alias(n) for n in requests.columns], *metrics)
        result = F.struct(F.lit(name).alias("policy_name"), *fields)
        df = decided(ruled(rows, cfg), as_of, cfg).select("whole", *done, result.alias(f"decision_{i}"))
        done.append(f"decision_{i}")
    return df.select(F.explode(F.array(*done)).alias("decision")).select("decision.*")


def user_policy_rows(policy_rows: DataFrame) -> DataFrame:
    """The 26-column user table: requests with at least one usable account."""
    return policy_rows.where((F.col("route") == "HIT") & (F.col("n_usable") > 0)).select(
        "request_id", *[n for n, _ in s.USER_POLICY_FIELDS]
    )


# --- fallbacks that look at a whole report ----------------------------------


def with_report_facts(
    accounts: DataFrame, facts: dict[str, Column], key: str = "request_id"
) -> DataFrame:
    """Rows with facts of their request: each is true if its condition holds for any row.

    The facts are combined before the shuffle and joined back on the key, so a request with very
    many rows is a skewed join, whose rows Spark deals out over several tasks at run time.
    """
    known = accounts.groupBy(key).agg(*[F.bool_or(c).alias(n) for n, c in facts.items()])
    return accounts.join(known, key, "left")


def with_highcredit(accounts: DataFrame) -> DataFrame:
    """Account rows (highcredit, sanctionamount, creditlimit) with the high credit filled up."""
    high, sanction = F.col("highcredit"), F.col("sanctionamount")
    rows = with_report_facts(accounts, {"_known": high.isNotNull() | sanction.isNotNull()})
    filled = export.highcredit(high, sanction, F.col("creditlimit"), F.col("_known"))
    return rows.withColumn("highcredit", filled).drop("_known")


def with_suit_filed(accounts: DataFrame, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Account rows (suit_status, suit) with the column ``suitfiledstatus``."""
    status = F.col("suit_status")
    rows = with_report_facts(accounts, {"_known": status.isNotNull()})
    filled = export.suit_filed(status, F.get("suit", F.lit(0)), F.col("_known"), cfg)
    return rows.withColumn("suitfiledstatus", filled).drop("_known")


# --- flat tables out of documents, and output tables out of flat tables ------


def accounts_from_requests(
    requests: DataFrame, as_of: AsOf, detail: bool = False
) -> DataFrame:
    """Parsed documents -> the account table this plan reads; with ``raw`` if ``detail``."""
    date = _date_column(as_of)
    rows = requests.select("request_id", *date, F.posexplode("raw_accounts").alias("i", "a"))
    as_of = F.col("as_of") if date else as_of
    fields = parse.typed_account(F.col("a"), F.col("i"), as_of, detail)
    typed = rows.select("request_id", *(["as_of"] if date else []), *[v.alias(n) for n, v in fields.items()])
    return typed.withColumns(parse.dated(F.col, CURRENT, as_of)).drop("days")


def _date_column(as_of: AsOf) -> list[Column]:
    return [as_of.alias("as_of")] if per_request(as_of) else []


def tables_from_requests(
    parsed: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT, saved: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parsed documents -> request, account and enquiry tables with all their fields.

    Documents that cannot be taken apart, or whose score is no number, have no place in flat
    tables (where a null score means that none was sent) and are left out. With ``saved``, a new path that
    belongs to the caller, the parsed documents are written there once and all three tables read that copy;
    else each of them parses the documents when it is read. With a date column all three have ``as_of``.
    """
    unreadable = (F.col("route") == "HIT") & F.col("score").isNull()
    known = documents.with_inputs(parsed, as_of, cfg).where(
        documents.reading_error().isNull() & ~unreadable
    )
    if saved:
        known.write.parquet(saved)
        known = known.sparkSession.read.schema(known.schema).parquet(saved)
    low, high = F.col("min_income"), F.col("max_income")
    date = _date_column(as_of)
    requests = known.select(
        "request_id", "user_id", "route", "reportnumber", "score", "limit_score", "base_limit",
        low.try_cast("double").alias("min_income"), high.try_cast("double").alias("max_income"),
        high.isNull().alias("income_open_ended"), "rows_per_account", "header", "header_lists",
        "header_rows", "inquiry", "phones", "top_error", "report_error", "enquiry_summary", *date,
    )
    accounts = accounts_from_requests(known, as_of, detail=True)
    enquiries = known.select("request_id", *date, F.explode("enquiries").alias("e"))
    return requests, accounts, enquiries.select("request_id", *(["as_of"] if date else []), "e.*")


def _without_error(requests, accounts, enquiries, as_of, cfg) -> DataFrame:
    """Requests without an error, with the facts of their report and their enquiry count."""
    rows = decided(policy_table(requests, accounts, enquiries, as_of, cfg), as_of, cfg)
    return rows.where(F.col("error_reason").isNull())


def account_table(
    requests: DataFrame,
    accounts: DataFrame,
    enquiries: DataFrame,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
) -> DataFrame:
    """The 271-column account table from flat tables (as ``tables_from_requests`` gives them).

    Accounts are read twice: for the roll-up that decides their request and holds the facts of the report, and
    as the rows that meet their request once.
    """
    known = _without_error(requests, accounts, enquiries, as_of, cfg).select(
        *requests.columns, "error_reason", "high_known",
        F.col("max_inq_l3m").alias("inq_flag"), F.struct("any_suit_status").alias("facts"),
    )
    staged = acc.score_accounts(accounts, as_of, cfg).where(acc.usable(F.col))
    own = F.struct(*[F.col(n) for n in staged.columns if n != "request_id"])
    staged = staged.select(F.col("request_id").alias("of_request"), own.alias("acct"))
    # Accounts count for requests with a history only; the others have rows of their header.
    same = (known["request_id"] == staged["of_request"]) & (known["route"] == "HIT")
    both = known.join(staged, same, "left")
    none = F.array().cast(f"array<{staged.schema['acct'].dataType.simpleString()}>")
    both = both.withColumn("accounts", F.when(F.col("acct").isNotNull(), F.array("acct")).otherwise(none))
    rows = both.withColumn("row", F.explode(export.account_rows()))
    return export.account_columns(rows, cfg)


def enquiry_table(
    requests: DataFrame,
    accounts: DataFrame,
    enquiries: DataFrame,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
) -> DataFrame:
    """The 8-column enquiry table from flat tables."""
    known = _without_error(requests, accounts, enquiries, as_of, cfg).where(F.col("route") == "HIT")
    rows = enquiries.join(known.select("request_id"), "request_id")
    columns = export.enquiry_columns(F.struct("raw", "date"), as_of, cfg)
    return rows.select("request_id", *[v.alias(n) for n, v in columns.items()])
