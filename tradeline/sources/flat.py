"""Flat tables that lie by request: stored in buckets, so that no plan over them shuffles accounts.

A request's accounts share a bucket, so a request with a large part of all accounts makes one large task; for such
deliveries leave the tables as they come, which ``ledger`` combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("requests", "accounts", "enquiries")


def write_flat_tables(tables: tuple[DataFrame, DataFrame, DataFrame], name: str, path: str, buckets: int = 200) -> None:
    """Store requests, accounts and enquiries as ``<name>_requests`` and so on, in files below ``path``."""
    for kind, df in zip(TABLES, tables, strict=True):
        # Rows are dealt by bucket first: one file for each bucket, not one for each bucket and task.
        dealt = df.repartition(buckets, "request_id")
        writer = dealt.write.bucketBy(buckets, "request_id").sortBy("request_id")
        writer.option("path", f"{path}/{kind}").mode("overwrite").saveAsTable(f"{name}_{kind}")


def read_flat_tables(spark: SparkSession, name: str) -> tuple[DataFrame, ...]:
    """The three tables, lying by request_id."""
    return tuple(spark.table(f"{name}_{kind}") for kind in TABLES)
