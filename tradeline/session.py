"""Session settings, the shared work folder and its file system."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "tradeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        # Recording the call site of every column expression costs more than
        # building the expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir``, else below the warehouse.

    On a cluster a warehouse on a local disk is no such folder, so the setting is needed there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and urlsplit(warehouse).scheme in ("", "file"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/work"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the work folder."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that nothing before it runs again; Spark removes it with the frame."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()


class Files:
    """Whole folders and small marker files on the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """``source`` takes the place of ``target``, which is deleted if it exists."""
        self.delete(target)
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def mark(self, path: str) -> None:
        """An empty file."""
        self._fs.create(self._path(path), True).close()

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        if not self.exists(path):
            return []
        return [f.getPath().getName() for f in self._fs.listStatus(self._path(path))]
