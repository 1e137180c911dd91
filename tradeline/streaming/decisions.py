"""Streaming decisions: the batch expressions on an unbounded table.

A request is decided from its own document, so the query is a stateless map: no
watermark, no state store, append mode.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf
from tradeline.operators.parse import parse_requests
from tradeline.plans.documents import decide_documents, score_requests
from tradeline.session import Files
from tradeline.sources.requests import with_stable_ids
from tradeline.sources.sinks import write_tables


def decide_stream(raw: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """Streaming decision table. A request without an id is named by its block and digest."""
    place = F.concat_ws("#", "block", "digest")
    named = raw.withColumn("request_id", F.coalesce("request_id", place)).drop("block")
    return decide_documents(named, as_of, cfg)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _decision_date(files: Files, out: str, run: str, batch_id: int) -> dt.date:
    """Today when the batch is first tried; a repeated batch finds that date again."""
    folder = f"{out}/_dates/run={run},batch={batch_id}"
    kept = files.names(folder)
    if kept:
        return dt.date.fromisoformat(min(kept))
    today = dt.date.today()
    files.mark(f"{folder}/{today.isoformat()}")
    return today


def run_stream(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    as_of: AsOf | None = None,
    cfg: PolicyConfig = CURRENT,
    available_now: bool = True,
) -> StreamingQuery:
    """Write the five output tables per micro-batch.

    Each stream (checkpoint) owns its folders and each batch one of them, which it replaces when
    Spark repeats the batch after a failure, so results appear once and no other stream's or job's
    rows are touched. Requests without an id of their own have one that a repeated batch finds again. ``as_of`` may be a
    column, a date for each request. Without ``as_of`` each batch is decided as of the day it was first tried. The
    scored batch is kept for its five writes; a lost executor's part is read again from the source.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = _stream_id(spark, checkpoint)
        date = _decision_date(Files(spark, out), out, run, batch_id) if as_of is None else as_of
        scored = score_requests(parse_requests(with_stable_ids(batch), cfg), date, cfg)
        kept = scored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_tables(kept, out, date, cfg, run=run, batch=batch_id)
        finally:
            kept.unpersist()

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
