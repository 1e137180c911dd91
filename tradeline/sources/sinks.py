"""Writers for the output tables and the JSON result documents.

Every run owns the folder ``<table>/as_of=.../run=...`` of each table (a stream one for each
micro-batch below it), so no run can replace the rows of another. The five tables are written to a
staging folder first, then moved into place, and last a marker says that the run is complete;
``read_table`` reads complete runs only.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeline.config import CURRENT, PolicyConfig
from tradeline.functions.dates import AsOf, per_request
from tradeline.plans import export
from tradeline.session import Files

TABLES = ("decision", "bureau", "enquiry", "user_policy", "quarantine")


def table_frames(
    scored: DataFrame, as_of: AsOf, cfg: PolicyConfig = CURRENT
) -> dict[str, DataFrame]:
    """The five output tables of scored requests."""
    return {
        "decision": export.decision_table(scored),
        "bureau": export.account_table(scored, cfg),
        "enquiry": export.enquiry_table(scored, as_of, cfg),
        "user_policy": export.user_policy_table(scored),
        "quarantine": export.quarantine_table(scored),
    }


def write_tables(
    scored: DataFrame,
    path: str,
    as_of: AsOf,
    cfg: PolicyConfig = CURRENT,
    *,
    run: str,
    batch: int | None = None,
) -> None:
    """Write the five tables of one run (and micro-batch), all of them or none.

    A run that is repeated under the same name replaces its own rows, so they appear once. If requests have
    dates of their own (``as_of`` is a column), each date is a part that is written by itself.
    """
    if per_request(as_of):
        dates = [r[0] for r in scored.select(as_of.cast("date")).distinct().collect()]
        for date in dates:
            _write_part(scored.where(as_of.cast("date").eqNullSafe(F.lit(date))), path, date, cfg, run, batch)
    else:
        _write_part(scored, path, as_of, cfg, run, batch)


def _write_part(
    scored: DataFrame, path: str, as_of: dt.date | None, cfg: PolicyConfig, run: str, batch: int | None
) -> None:
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"a run is named by letters, digits, points and dashes, not {run!r}")
    files = Files(scored.sparkSession, path)
    date = as_of.isoformat() if as_of else "__HIVE_DEFAULT_PARTITION__"  # read as null
    part = f"as_of={date}/run={run}" + ("" if batch is None else f"/batch={batch}")
    marker = f"{path}/_complete/{part.replace('/', ',')}"
    staging = f"{path}/_staging/{part.replace('/', ',')}"
    files.delete(staging)
    for name, df in table_frames(scored, as_of or F.lit(None).cast("date"), cfg).items():
        df.write.parquet(f"{staging}/{name}")
    files.delete(marker)
    for name in TABLES:
        files.move(f"{staging}/{name}", f"{path}/{name}/{part}")
    files.mark(marker)
    files.delete(staging)


def complete_parts(spark: SparkSession, path: str) -> list[str]:
    """Folders (below each table) of the runs and micro-batches that were written completely."""
    return sorted(name.replace(",", "/") for name in Files(spark, path).names(f"{path}/_complete"))


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of all complete runs, with columns ``as_of``, ``run`` and, from streams, ``batch``."""
    parts = [f"{path}/{name}/{part}" for part in complete_parts(spark, path)]
    if not parts:
        raise FileNotFoundError(f"no complete run below {path}")
    plain = [p for p in parts if "/batch=" not in p]
    batches = [p for p in parts if "/batch=" in p]
    reader = spark.read.option("basePath", f"{path}/{name}")
    read = [reader.parquet(*group) for group in (plain, batches) if group]
    return read[0] if len(read) == 1 else read[0].unionByName(read[1], allowMissingColumns=True)


def write_result_documents(results: DataFrame, path: str, per_file: bool = False) -> None:
    """JSON lines of result documents; ``path`` must be new.

    ``results`` is (request_id, value[, file_name]). By default a line is the document, or with file
    names ``{"file_name": ..., "result": {...}}``. ``per_file=True`` writes a folder for each input
    file instead, ``processed_file_<its path>``, which suits small numbers of requests.
    """
    if "file_name" not in results.columns:
        results.select("value").write.text(path)
    elif per_file:
        results.select(
            F.concat(F.lit("processed_file_"), "file_name").alias("result"), "value"
        ).write.partitionBy("result").text(path)
    else:
        name = F.to_json(F.struct("file_name"))
        line = F.concat(F.rtrim(name, F.lit("}")), F.lit(', "result": '), "value", F.lit("}"))
        results.select(line.alias("value")).write.text(path)
