"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from basketry.scratch import folder_and_files

MIB = 1024 * 1024
# Bytes one task should read; adaptive execution merges shuffle partitions that turn out smaller.
PARTITION_BYTES = 128 * MIB
# A shuffle holds a block per map task and reduce task, so very big inputs get bigger partitions
# rather than more of them.
MAX_PARTITIONS = 100_000
# Bytes of stored input of a task that groups it: groups weigh much more in memory than rows in a compressed file.
GROUPED_BYTES = 8 * MIB

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot order, product or customer: split its join partition, even at the price of a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark broadcasts a join side only if its size, estimated or seen at run time, stays below this;
    # a larger one is shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * MIB),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query of the session as soon as it ends, while this lasts.

    Otherwise they stay until the driver's garbage is collected, so a job of many steps that all write
    tables keeps the shuffles of steps long done. A query that runs again writes its files anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def require_skew_handling(spark: SparkSession) -> None:
    """Raise if the session would leave a hot join key in one task."""
    needed = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    if off := [key for key in needed if spark.conf.get(key, "true") != "true"]:
        raise ValueError(f"set {', '.join(off)} to true")


def partition_bytes(input_bytes: int) -> int:
    """Bytes per scan task: the usual size unless that would make too many tasks."""
    return max(PARTITION_BYTES, -(-input_bytes // MAX_PARTITIONS))


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for a run that reads ``input_bytes``, at least one per core."""
    return max(cores, -(-input_bytes // partition_bytes(input_bytes)))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame is made of, as their folders list them; 0 if it is made of none."""
    folders: dict[str, set[str]] = {}
    for file in df.inputFiles():
        folder, _, name = file.rpartition("/")
        folders.setdefault(folder, set()).add(unquote(name))
    total = 0
    for folder, names in folders.items():
        path, files = folder_and_files(df.sparkSession, unquote(folder))
        total += sum(s.getLen() for s in files.listStatus(path) if s.getPath().getName() in names)
    return total


def tasks_of(df: DataFrame) -> int:
    """Tasks for rows whose groups weigh much more in memory than in the shuffle.

    As many as the session has shuffle partitions, and more if the files behind the rows are large: a task's
    groups then stay the same in size when the input grows. Adaptive execution merges partitions by the bytes
    they were shuffled with; a number that is given stays.
    """
    wanted = min(MAX_PARTITIONS, -(-input_bytes(df) // GROUPED_BYTES))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def configure(builder: SparkSession.Builder, input_bytes: int = 0, cores: int = 8) -> SparkSession.Builder:
    """Apply the settings to a session builder; the caller keeps master, memory and app name."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.files.maxPartitionBytes", str(partition_bytes(input_bytes))).config(
        "spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores))
    )
