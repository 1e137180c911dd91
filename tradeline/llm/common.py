"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeline.session import work_folder

#: Texts are handled in slices of about this many characters, so that the Python objects
#: made from one slice stay small whatever the size of an Arrow batch.
SLICE_CHARS = 2_000_000


_shipped: set[str] = set()


#: Texts that Python gets at a time, when the session allows more.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make a session fit for these operators.

    Arrow batches hold at most ``BATCH_ROWS`` rows, as rows are whole texts. The package is sent to the
    executors, which a session may have been started without; Spark itself hands out the archive, and
    it is made once for each application.
    """
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="run-")), f"{root.name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``, else one below the warehouse."""
    return work_folder(spark)


#: Tasks and files of an intermediate result at most, for each core of the cluster.
FILES_PER_CORE = 8


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in at most ``FILES_PER_CORE`` tasks and files for each core; a task then reads several partitions.

    Unchanged where the number of cores is not known before the work (dynamic allocation).
    """
    spark = df.sparkSession
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return df
    return df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that nothing before it runs again."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return few_files(df).checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote, by the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def map_batches(
    df: DataFrame,
    func: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | T.StructType,
    forget: Callable[[], None] | None = None,
) -> DataFrame:
    """``func`` on every Arrow batch; the batches of a partition stay independent.

    ``forget`` empties what ``func`` remembers: a Python worker outlives its tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield func(batch)
        if forget:
            forget()
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def text_slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts (null: empty) in slices of about ``limit`` characters, at least one text each."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def links_to_components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (u long, v long): node, component (its smallest node).

    Alternating large-star and small-star steps. A step sends every node to the smallest of its
    neighbours; the aggregate is a minimum and is combined before the shuffle, and a node with many
    neighbours meets them in an inner join that Spark can split. Every round is checkpointed.
    """
    edges = cut(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct()
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct())
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    members = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
