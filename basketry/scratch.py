"""Intermediate tables in the shared folder, to cut lineage and to read a result more than once."""

from __future__ import annotations

import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# The same for a local session that was started without it.
LOCAL_SETTING = "spark.basketry.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get(LOCAL_SETTING, None)
    if not folder:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return folder.rstrip("/")


def name_local_folder(spark: SparkSession) -> None:
    """Give a local session that names no shared folder one of its own; for tests and trial runs.

    A cluster's session is left as it is: there the setting is required.
    """
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        return
    if not (spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get(LOCAL_SETTING, None)):
        spark.conf.set(LOCAL_SETTING, tempfile.mkdtemp(prefix="basketry-"))


def folder_and_files(spark: SparkSession, folder: str):
    """A path and its file system, as the session's Hadoop settings resolve them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = folder_and_files(spark, folder)
    files.delete(path, True)


class Scratch:
    """A folder of written tables that one job owns.

    A written table survives lost executors, has a row count in its footers, and reads back only
    the columns a later step asks for. ``close`` deletes the folder; what nobody closed, because the
    caller still reads it, goes when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)
        self._noted = False

    def path(self, name: str) -> str:
        if not self._noted:
            path, files = folder_and_files(self.spark, self.root)
            files.mkdirs(path)
            files.deleteOnExit(path)
            self._noted = True
        return f"{self.root}/{next(self._numbers):03d}-{name}"

    def keep(self, df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
        """Write ``df`` once, compressed as the session does or with ``codec``, and return the written table."""
        path = self.path(name)
        df.write.parquet(path, compression=codec)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete the folder. Call it once nothing reads the kept tables any more."""
        delete_folder(self.spark, self.root)
