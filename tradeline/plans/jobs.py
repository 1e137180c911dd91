"""End-to-end batch job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf, per_request
from tradeline.operators.parse import parse_requests
from tradeline.plans.documents import score_requests
from tradeline.plans.export import result_documents
from tradeline.session import Files, new_path
from tradeline.sources.sinks import write_result_documents, write_tables


def run_batch(
    raw: DataFrame,
    out: str,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
    *,
    run: str | None = None,
    documents: str | None = None,
    per_file: bool = False,
) -> str:
    """Decide all requests, write the five output tables and, if asked, the result documents.

    Returns the name of the run, by default a new one; a run repeated under its name replaces its own
    rows and nothing else. ``as_of`` may be a column of ``raw``, a date for each request. The scored requests are written once to the shared work folder, so the JSON
    is parsed once and a lost executor costs a re-read; that copy is deleted at the end.
    """
    spark = raw.sparkSession
    run = run or uuid.uuid4().hex
    scored_path = new_path(spark, "scored")
    try:
        scored = score_requests(parse_requests(raw, cfg), as_of, cfg)
        if per_request(as_of):  # a folder for each date, so that each date's tables read their own rows only
            scored = scored.withColumn("decision_date", as_of.cast("date"))
            scored.write.partitionBy("decision_date").parquet(scored_path)
            as_of = F.col("decision_date")
        else:
            scored.write.parquet(scored_path)
        scored = spark.read.schema(scored.schema).parquet(scored_path)
        write_tables(scored, out, as_of, cfg, run=run)
        if documents:
            write_result_documents(result_documents(scored, as_of, cfg), documents, per_file)
    finally:
        Files(spark, scored_path).delete(scored_path)
    return run
