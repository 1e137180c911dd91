"""Credit-bureau policy decisions as Spark DataFrame plans."""

from tradeline.config import CURRENT, LAUNCH, PolicyConfig, Rule
from tradeline.functions.limits import credit_limit
from tradeline.operators.accounts import roll_up as aggregate_policy
from tradeline.operators.accounts import score_accounts
from tradeline.operators.parse import parse_requests
from tradeline.plans.documents import decide_documents, decide_policies, score_requests
from tradeline.plans.export import conform, result_documents
from tradeline.plans.jobs import run_batch
from tradeline.plans.ledger import decide_policies_tables, decide_tables, policy_table
from tradeline.sources.requests import read_request_files, read_requests, stream_requests
from tradeline.sources.sinks import table_frames as export_tables
from tradeline.sources.sinks import read_table, write_result_documents, write_tables
from tradeline.streaming.decisions import decide_stream, run_stream
from tradeline.streaming.tables import decide_table_streams

__all__ = [
    "CURRENT", "LAUNCH", "PolicyConfig", "Rule", "aggregate_policy", "conform", "credit_limit",
    "decide_documents", "decide_policies", "decide_policies_tables", "decide_stream", "decide_table_streams", "decide_tables", "export_tables", "parse_requests",
    "policy_table", "read_request_files", "read_requests", "read_table", "result_documents", "run_batch",
    "run_stream", "score_accounts", "score_requests", "stream_requests", "write_result_documents",
    "write_tables",
]
