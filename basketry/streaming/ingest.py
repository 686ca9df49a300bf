"""Incremental load: raw files that have not been loaded yet, as a stream that stops when done."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.schemas import Table
from basketry.sources.load import CORRUPT, csv_options, raw_schema, typed, write_loaded
from basketry.sources.raw import raw_table_folder
from basketry.sources.staging import DAY, read_accepted, read_rejected, staging_schema

BATCH = "load_batch"
FILES_PER_BATCH = 10_000


def new_files(
    spark: SparkSession, root: str, table: Table, *, multi_line: bool, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream over a table's raw files of all days, as text, with the day taken from the folder.

    ``multi_line`` says whether quoted CSV fields may hold line breaks; files without are split.
    """
    reader = spark.readStream.schema(raw_schema(table)).option("maxFilesPerTrigger", files_per_batch)
    folder = f"{raw_table_folder(root, table)}/*"
    if table.raw_format == "json":
        files = reader.option("columnNameOfCorruptRecord", CORRUPT).json(folder)
    else:
        files = reader.options(**csv_options()).option("multiLine", str(multi_line).lower()).csv(folder)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return files.withColumn(DAY, day.cast("date"))


def ingest(
    spark: SparkSession,
    root: str,
    table: Table,
    target: str,
    run_ts: datetime,
    *,
    multi_line: bool,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Load every raw file not loaded before, then stop.

    Each batch replaces its own folder, so a batch that is repeated after a failure leaves no
    duplicates. For folders that only ever get new files: a file replaced under the same name is not
    loaded again (``sources.ledger`` does that).
    """

    def write(batch: DataFrame, number: int) -> None:
        path = f"{target}/staging/{table.name}/{BATCH}={number}"
        write_loaded(typed(batch, table, keep=(DAY,)), table, run_ts, path, (DAY,))

    stream = (
        new_files(spark, root, table, multi_line=multi_line, files_per_batch=files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{target}/checkpoints/{table.name}")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def read_ingested(spark: SparkSession, target: str, table: Table) -> DataFrame:
    """All rows loaded so far, with their day."""
    return read_accepted(spark, f"{target}/staging/{table.name}", staging_schema(table))


def read_ingest_rejects(spark: SparkSession, target: str, table: Table) -> DataFrame:
    return read_rejected(spark, f"{target}/staging/{table.name}", table)
