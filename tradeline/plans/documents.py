"""Decision plan over request documents: one row in, one row out, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline import schemas as s
from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf, per_request
from tradeline.functions.limits import credit_limit
from tradeline.functions.numbers import is_bad_number
from tradeline.operators import accounts as acc
from tradeline.operators import parse, policy
from tradeline.operators.once import evaluated_once


# Columns of a parsed request; anything else was carried in by the caller.
READ_FIELDS = (
    "request_id", "user_id", "bad_json", "features", "min_income", "max_income", "no_envelope",
    "top_error", "header", "header_lists", "inquiry", "phones", "report_error", "no_report",
    "header_rows",
    "raw_accounts", "enquiry_summary", "raw_enquiries", "score_details", "account_keys",
)

# What the output tables read beside the decision.
DETAIL_FIELDS = (
    "route", "header", "header_lists", "header_rows", "inquiry", "phones", "top_error", "report_error",
    "enquiry_summary", "high_known", "score", "inq_flag", "facts", "policy", "reportnumber",
    "accounts", "enquiries",
)


def route() -> Column:
    """INVALID input, NOHIT (bureau knows nobody) or HIT."""
    return (
        F.when(F.col("top_error").isNotNull(), "INVALID")
        .when(F.col("report_error").isNotNull(), "NOHIT")
        .otherwise("HIT")
    )


def _structs(items: Column, fields) -> Column:
    """``transform`` to a struct given ``fields(x, i) -> {name: Column}``."""
    return F.transform(
        items, lambda x, i: F.struct(*[v.alias(n) for n, v in fields(x, i).items()])
    )


def _limit(cfg: PolicyConfig) -> Column:
    if not cfg.envelope:
        return F.lit(None).cast("bigint")
    low, high = F.col("min_income"), F.col("max_income")
    base, score = F.col("base_limit"), F.col("limit_score")
    return credit_limit(
        base, score, low.try_cast("double"), high.try_cast("double"), high.isNull(), cfg
    )


def with_inputs(requests: DataFrame, as_of: AsOf, cfg: PolicyConfig) -> DataFrame:
    """Typed request-level inputs beside the parsed report."""
    features = F.col("features")
    bad_value = lambda e: e["value"].isNull() | is_bad_number(e["value"])
    return requests.withColumns(
        {
            "route": route(),
            "enquiries": parse.typed_enquiries(F.col("raw_enquiries"), as_of),
            "score": parse.read_score(F.col("score_details"), cfg.missing_score),
            "reportnumber": parse.report_number(),
            "limit_score": parse.last_feature(features, "offline_bnpl_score"),
            "base_limit": parse.last_feature(features, "offline_bnpl_limit"),
            "bad_feature": acc.holds(F.exists(features, bad_value)),
            "rows_per_account": F.greatest(
                F.col("header_rows"), F.array_size("phones"), F.lit(1)
            ),
        }
    )


def _with_accounts(df: DataFrame, as_of: AsOf, cfg: PolicyConfig, detail: bool) -> DataFrame:
    """The account array with all stages applied, and its roll-up ``facts``."""
    known: list[str] = []

    def typed(a: Column, i: Column) -> dict[str, Column]:
        fields = parse.typed_account(a, i, as_of, detail)
        known[:] = list(fields)
        return fields

    df = df.withColumn("accounts", _structs(F.col("raw_accounts"), typed))
    first, *rest = acc.STAGES
    for stage in (acc.together(parse.dated, first), *rest):
        items, known = acc.extend_structs(F.col("accounts"), known, stage, cfg, as_of)
        df = df.withColumn("accounts", items)
    facts = acc.fold_structs(F.col("accounts"))
    if cfg.key_presence:
        facts = facts.withField("any_suit_status", _has_key("SuitFiledStatus"))
    return df.withColumn("facts", facts)


def _has_key(name: str) -> Column:
    """Whether any account of the report was sent with this key."""
    return acc.holds(F.array_contains("account_keys", name))


def _high_known(cfg: PolicyConfig) -> Column:
    if cfg.key_presence:
        return _has_key("HighCredit") | _has_key("SanctionAmount")
    return F.exists("raw_accounts", lambda a: a["HighCredit"].isNotNull() | a["SanctionAmount"].isNotNull())


def _metrics(cfg: PolicyConfig) -> dict[str, Column]:
    """The thirteen rolled-up metrics by name."""
    elsewhere = {
        "max_inq_l3m": F.col("inq_flag"),
        "max_score": acc.holds(policy.score_passes(F.col("score"), cfg)),
    }
    return {n: elsewhere.get(n, F.col(f"facts.{n}")) for n, _ in s.METRIC_FIELDS}


def _surviving(scored: Column) -> Column:
    """Usable accounts, those with a visible history first."""

    def kept(part: str) -> Column:
        return F.filter(
            F.col("accounts"),
            lambda a: acc.usable(lambda n: a[n]) & (acc.availability(a["lag"]) == part),
        )

    both = F.concat(kept(acc.AVAILABLE), kept(acc.UNAVAILABLE))
    return F.when(scored, both)


def score_requests(
    requests: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT, detail: s.Detail = True
) -> DataFrame:
    """Decide every parsed request.

    Adds ``error_reason, accept_ind, bureau_history_status, bnpl_limit``, the
    26-field ``policy`` struct, the surviving ``accounts`` with their flags and
    the typed ``enquiries``. A request that cannot be processed keeps its row
    with an ``error_reason`` and null results. ``detail=False`` leaves out what only the output
    tables need, a collection keeps the named ones of ``DETAIL_FIELDS``.
    """
    c = F.col
    kept = (DETAIL_FIELDS if detail else ("policy",)) if isinstance(detail, bool) else tuple(detail)
    df = _with_accounts(with_inputs(requests, as_of, cfg), as_of, cfg, "accounts" in kept).withColumns(
        {
            "inq_flag": policy.count_recent(c("enquiries"), as_of, cfg),
            "bnpl_limit": _limit(cfg),
        }
    )
    metrics = _metrics(cfg)
    rules = policy.rule_outcomes(lambda n: metrics[n], cfg)
    rows = c("facts.n_accounts") * c("rows_per_account")
    df = df.withColumns(
        {
            "thin": policy.is_thin_file(c("facts.max_mob"), rows, cfg),
            "rules": F.struct(*[outcome.alias(n) for n, outcome in rules.items()]),
            "error_reason": _error_reason(as_of, cfg),
        }
    )
    ok = c("error_reason").isNull()
    scored = ok & (c("route") == "HIT")
    accepted = policy.all_pass(lambda n: c("rules")[n], cfg)
    outcome = lambda n: c("rules")[n] if n in rules else F.lit(None).cast("boolean")
    policy_row = F.struct(
        c("reportnumber"),
        *[value.alias(n) for n, value in metrics.items()],
        *[outcome(n).alias(n) for n in s.RULE_NAMES],
    )
    results = {
        "accept_ind": F.when(
            ok, policy.accept_indicator(c("route"), c("facts.n_usable"), accepted)
        ),
        "bureau_history_status": F.when(ok, policy.history_status(c("route"), c("thin"))),
        "bnpl_limit": F.when(ok, c("bnpl_limit")),
        "policy": F.when(scored & (c("facts.n_usable") > 0), policy_row),
    }
    for name, value in (
        ("accounts", lambda: _surviving(scored)),
        ("enquiries", lambda: F.when(scored, c("enquiries"))),
        ("high_known", lambda: _high_known(cfg)),
    ):
        if name in kept:
            results[name] = value()
    df = df.withColumns(results)
    carried = [n for n in requests.columns if n not in READ_FIELDS]
    return evaluated_once(df.select(*[n for n, _ in s.DECISION_FIELDS], *carried, *kept))


def reading_error() -> Column:
    """Why a document cannot be taken apart at all; null if it can."""
    c = F.col
    return (
        F.when(c("bad_json"), "BAD_JSON")
        .when(c("no_envelope"), "MISSING_ENVELOPE")
        .when(c("bad_feature"), "BAD_NUMBER")
        .when(c("header").isNull() | c("phones").isNull(), "MISSING_HEADER")
        .when((c("route") != "INVALID") & c("no_report"), "MISSING_REPORT")
        .when((c("route") == "HIT") & c("raw_accounts").isNull(), "MISSING_REPORT")
    )


def _error_reason(as_of: AsOf, cfg: PolicyConfig) -> Column:
    c = F.col
    reading = reading_error()
    if per_request(as_of):
        reading = F.coalesce(reading, policy.missing_date(as_of))
    request_level = {"score", "reportnumber", "enquiry_summary"}
    get = lambda n: c(n) if n in request_level else c(f"facts.{n}")
    report = F.when(c("route") == "HIT", policy.report_error(get, cfg))
    if not cfg.envelope:
        return F.coalesce(reading, report)
    return F.coalesce(reading, report, F.when(c("bnpl_limit").isNull(), "BAD_LIMIT_INPUT"))


def decide_documents(
    raw: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT
) -> DataFrame:
    """Decision table straight from JSON, parsing only the fields it needs."""
    parsed = parse.parse_requests(raw, cfg, detail=False)
    return score_requests(parsed, as_of, cfg, detail=False).select(
        *[n for n, _ in s.DECISION_FIELDS]
    )


def decide_policies(raw: DataFrame, as_of: AsOf, policies: Mapping[str, PolicyConfig]) -> DataFrame:
    """Decisions of several policies side by side: a row for each request and policy.

    The documents are read and parsed once, in the enveloped shape if any policy needs the envelope; a policy
    without one then decides on the bare report inside. Each policy scores the same parsed row.
    """
    shape = any(cfg.envelope for cfg in policies.values())
    parsed = parse.parse_requests(raw, replace(CURRENT, envelope=shape, key_presence=any(p.key_presence for p in policies.values())), detail=False)
    fields = [n for n, _ in s.DECISION_FIELDS]
    df, done = parsed.select(F.struct(*parsed.columns).alias("document")), []
    for i, (name, cfg) in enumerate(policies.items()):
        rows = df.select("document", *done, "document.*")
        if shape and not cfg.envelope:
            unread = {n: F.lit(None).cast(parsed.schema[n].dataType) for n in ("user_id", "features", "min_income", "max_income")}
            rows = rows.withColumns(unread | {"no_envelope": F.lit(False)})
        scored = score_requests(rows, as_of, cfg, detail=())
        result = F.struct(F.lit(name).alias("policy_name"), *fields)
        df = scored.select("document", *done, result.alias(f"decision_{i}"))
        done.append(f"decision_{i}")
    return df.select(F.explode(F.array(*done)).alias("decision")).select("decision.*")
