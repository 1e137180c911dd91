"""``spark-submit``-able batch and streaming jobs.

    python -m tradeline batch  --requests IN --out OUT --as-of 2024-01-31
    python -m tradeline stream --requests IN --out OUT --checkpoint CP [--as-of 2024-01-31]

A batch needs its decision date. A stream without one decides each micro-batch as of its day.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from tradeline import config
from tradeline.plans.jobs import run_batch
from tradeline.session import build_session
from tradeline.sources.requests import read_request_files, read_requests, stream_requests
from tradeline.streaming.decisions import run_stream

PROFILES = {"current": config.CURRENT, "launch": config.LAUNCH}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradeline", description="Credit-bureau policy decisions")
    parser.add_argument("mode", choices=("batch", "stream"))
    parser.add_argument("--requests", required=True, help="folder of request documents")
    parser.add_argument("--out", required=True, help="folder for the output tables")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="decision date")
    parser.add_argument("--run", help="name of the run; the same name replaces that run")
    parser.add_argument("--id-field", help="field of the document that holds the request id")
    parser.add_argument("--date-field", help="field of the document that holds its decision date")
    parser.add_argument("--stable-ids", action="store_true", help="ids that every read of a file finds again")
    parser.add_argument("--work", help="shared folder for intermediate files")
    parser.add_argument("--profile", choices=tuple(PROFILES), default="current")
    parser.add_argument("--whole-files", action="store_true", help="one request per file")
    parser.add_argument("--documents", help="also write JSON result documents here")
    parser.add_argument("--per-file", action="store_true", help="one result folder per input file")
    parser.add_argument("--files-per-batch", type=int, default=1000, help="input files of a micro-batch")
    parser.add_argument("--checkpoint", help="streaming checkpoint folder")
    parser.add_argument("--keep-running", action="store_true", help="do not stop at the last file")
    args = parser.parse_args(argv)
    if args.mode == "stream" and not args.checkpoint:
        parser.error("stream needs --checkpoint")
    if args.mode == "batch" and not (args.as_of or args.date_field):
        parser.error("batch needs --as-of or --date-field")
    if args.as_of and args.date_field:
        parser.error("either --as-of or --date-field")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    cfg = PROFILES[args.profile]
    conf = {"spark.checkpoint.dir": args.work} if args.work else {}
    spark = build_session(f"tradeline-{args.mode}", **conf)
    as_of = F.col("as_of") if args.date_field else args.as_of
    if args.mode == "stream":
        raw = stream_requests(spark, args.requests, args.files_per_batch, args.id_field, args.date_field)
        run_stream(
            raw, args.out, args.checkpoint, as_of, cfg, available_now=not args.keep_running
        ).awaitTermination()
        return
    if args.whole_files:
        raw = read_request_files(spark, args.requests, args.id_field, args.date_field)
    else:
        raw = read_requests(spark, args.requests, args.id_field, args.date_field, args.stable_ids)
    run_batch(
        raw, args.out, as_of, cfg, run=args.run, documents=args.documents, per_file=args.per_file
    )


if __name__ == "__main__":
    main()
