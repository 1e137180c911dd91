"""Request documents from text files, in batch or as a stream.

Every submission is a request of its own. Two equal documents are two requests; the digest of the
document is a column of its own. Callers whose documents carry an id or a decision date name those fields.

Without an id field a request is named in one of two ways:

* by its place (file, block and row in the task). This needs no shuffle, but another packing of files into tasks,
  or further files in the folder, give other names;
* with ``stable_ids``, by file, digest and its number among equal lines of that file. Equal lines are alike, so
  it doesn't matter which of them has which number, and every read of the file finds the same ids. Only documents
  that occur more than once in a file are shuffled, dealt by file, digest and block.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeline.session import saved

#: Documents that occur more than once in a file and may be broadcast (32 bytes each).
BROADCAST_REPEATED = 500_000


def document_digest(value: Column) -> Column:
    """The same for equal documents."""
    return F.sha2(value, 256)


def _block() -> Column:
    """File and start of the block that a task read."""
    return F.concat_ws("#", "_metadata.file_path", F.col("_metadata.file_block_start"))


def _row() -> Column:
    """The row's place in its task. A task that is repeated reads the same block in the same order."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def _copies(lines: DataFrame) -> DataFrame:
    """``lines`` (file, start, digest and others) with ``copy``, the number among equal lines of a file."""
    keys = ["file_hash", "digest"]
    lines = lines.withColumn("file_hash", F.xxhash64("file"))
    repeated = saved(lines.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys))
    if not (n := repeated.count()):
        return lines.withColumn("copy", F.lit(0).cast("bigint")).drop("file_hash")
    repeated = F.broadcast(repeated) if n <= BROADCAST_REPEATED else repeated
    single = lines.join(repeated, keys, "left_anti").withColumn("copy", F.lit(0).cast("bigint"))
    several = lines.join(repeated, keys)
    # A file's equal lines may be very many: they are numbered block by block, and blocks by their counts.
    own = Window.partitionBy(*keys, "start").orderBy("file")
    counts = several.groupBy(*keys, "start").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    several = several.withColumn("own", F.row_number().over(own)).join(counts, [*keys, "start"])
    several = several.withColumn("copy", F.col("before") + F.col("own") - 1)
    return single.unionByName(several.select(*single.columns)).drop("file_hash")


def with_stable_ids(lines: DataFrame) -> DataFrame:
    """``lines`` with ``request_id`` where it is null: file, digest and number among equal lines.

    ``lines`` has ``block`` (file and start of the block) and ``digest``; ``block`` goes.
    """
    placed = lines.withColumns(
        {"file": F.regexp_replace("block", r"#\d+$", ""), "start": F.substring_index("block", "#", -1).cast("bigint")}
    )
    name = F.concat_ws("#", "file", F.substring("digest", 1, 32), "copy")
    named = _copies(placed).withColumn("request_id", F.coalesce("request_id", name))
    return named.select(*[c for c in lines.columns if c != "block"])


def numbered(lines: DataFrame) -> DataFrame:
    """Lines of a micro-batch with ids by place: block and row."""
    place = F.concat_ws("#", "block", _row())
    return lines.withColumn("request_id", F.coalesce("request_id", place)).drop("block")


def _identified(
    lines: DataFrame, place: Column, id_field: str | None, date_field: str | None, *columns: Column
) -> DataFrame:
    """Lines with ``request_id`` (the named field, else the place), ``digest`` and, from its field, ``as_of``."""
    value = F.col("value")
    field = lambda name: F.get_json_object(value, f"$['{name}']")
    given = [field(id_field)] if id_field else []
    dated = [field(date_field).try_cast("date").alias("as_of")] if date_field else []
    return lines.select(
        value, F.coalesce(*given, place).alias("request_id"), document_digest(value).alias("digest"), *dated, *columns
    )


def read_requests(
    spark: SparkSession,
    path: str,
    id_field: str | None = None,
    date_field: str | None = None,
    stable_ids: bool = False,
) -> DataFrame:
    """JSON lines, one request per line. Large files are split between tasks.

    ``date_field`` names a field of the document with its decision date, which becomes column ``as_of``.
    """
    lines = spark.read.text(path)
    if stable_ids:
        unnamed = F.lit(None).cast("string")
        return with_stable_ids(_identified(lines, unnamed, id_field, date_field, _block().alias("block")))
    return _identified(lines, F.concat_ws("#", _block(), _row()), id_field, date_field)


def read_request_files(
    spark: SparkSession, path: str, id_field: str | None = None, date_field: str | None = None
) -> DataFrame:
    """One request per file; ``file_name`` (its path below ``path``) names the result document."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    file_path = F.col("_metadata.file_path")
    folder = re.sub("^[a-z0-9]+:/*", "/", path).strip("/")
    below = F.substring_index(file_path, f"/{folder}/", -1)
    return _identified(files, file_path, id_field, date_field, below.alias("file_name"))


def stream_requests(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = 1000,
    id_field: str | None = None,
    date_field: str | None = None,
) -> DataFrame:
    """JSON lines arriving in a folder, as an unbounded table; None takes all files that are there at once.

    ``request_id`` is null unless the named field holds it; ``block`` says where a line stands, and
    each micro-batch is given ids before it is decided.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    unnamed = F.lit(None).cast("string")
    return _identified(reader.text(path), unnamed, id_field, date_field, _block().alias("block"))
