"""Incremental load with a ledger of files: new and replaced files are loaded, what they replace no longer counts.

The ledger has a row for each file that was ever loaded: path, length, modification time and number of
the load. A file whose length or time has changed is loaded again; its earlier rows, and those of files
that vanished from a folder which has new ones, are superseded. Ledger and rows switch together, as one
version of a warehouse, so a run that fails leaves both as they were and is simply repeated.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import marks
from basketry.schemas import Table
from basketry.sources.load import REASON, read_raw, typed, with_verdict
from basketry.sources.raw import raw_table_folder
from basketry.sources.staging import ACCEPTED, DAY, RAW
from basketry.warehouse import Change, Warehouse

LEDGER_SCHEMA = "path string, folder string, length long, modified timestamp, load long, superseded_by long"
FILES_PER_LOAD = 10_000
FILE, LOAD = "_file", "_load"


def rows_name(table: Table) -> str:
    return f"{table.name}_loaded"


def ledger_name(table: Table) -> str:
    return f"{table.name}_ledger"


def listed(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """path, folder, length and modified of every raw file of the table; contents are not read."""
    folder = raw_table_folder(root, table)
    if not marks.names(spark, folder):
        return spark.createDataFrame([], LEDGER_SCHEMA).select("path", "folder", "length", "modified")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    meta = F.col("_metadata")
    return files.select(
        meta["file_path"].alias("path"),
        F.regexp_extract(meta["file_path"], "^(.*)/[^/]*$", 1).alias("folder"),
        meta["file_size"].alias("length"),
        meta["file_modification_time"].alias("modified"),
    )


def read_ledger(warehouse: Warehouse, table: Table) -> DataFrame:
    tables = warehouse.tables()
    stored = tables.get(ledger_name(table))
    return warehouse.open(stored) if stored else warehouse.spark.createDataFrame([], LEDGER_SCHEMA)


def fresh_files(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Files that are not in the ledger as they are now."""
    return files.join(ledger.where("superseded_by IS NULL"), ["path", "length", "modified"], "left_anti")


def next_ledger(ledger: DataFrame, files: DataFrame, fresh: DataFrame, load: int) -> DataFrame:
    """The ledger with the fresh files of a load, and with what they supersede marked."""
    again = fresh.select("path", F.lit(True).alias("_again"))
    there = files.select("path", F.lit(True).alias("_there"))
    touched = fresh.select("folder").distinct().withColumn("_touched", F.lit(True))
    noted = ledger.join(again, "path", "left").join(there, "path", "left").join(touched, "folder", "left")
    replaced = F.coalesce("_again", F.lit(False)) | (F.col("_there").isNull() & F.coalesce("_touched", F.lit(False)))
    by = F.when(F.col("superseded_by").isNull() & replaced, F.lit(load)).otherwise(F.col("superseded_by"))
    columns = ["path", "folder", "length", "modified", "load"]
    marked = noted.select(*columns, by.cast("long").alias("superseded_by"))
    added = fresh.select(*columns[:-1], F.lit(load).cast("long").alias("load"), F.lit(None).cast("long").alias("superseded_by"))
    return marked.unionByName(added)


def ingest_files(
    spark: SparkSession,
    root: str,
    table: Table,
    target: str,
    run_ts: datetime,
    *,
    multi_line: bool,
    files_per_load: int = FILES_PER_LOAD,
) -> int:
    """Load every raw file that is new or was replaced; returns how many were loaded.

    Files come in loads of ``files_per_load`` at most, in the order of their names; each load is one
    version of the warehouse at ``target``. Files that vanish together with their folder keep their
    rows: that is tidying up. A file that changes while it is read is loaded again by the next run.
    """
    warehouse, total = Warehouse(spark, target), 0
    while True:
        change = warehouse.change()
        files, ledger = listed(spark, root, table), read_ledger(warehouse, table)
        fresh = fresh_files(ledger, files).orderBy("path").limit(files_per_load).collect()
        if not fresh:
            return total
        load = (ledger.agg(F.max("load")).first()[0] or 0) + 1
        found = spark.createDataFrame(fresh, "path string, length long, modified timestamp, folder string")
        _load_files(change, table, [r.path for r in fresh], run_ts, load, multi_line)
        marked = next_ledger(ledger, files, found, load)
        change.write(ledger_name(table), marked.coalesce(1), "ledger")
        change.commit()
        total += len(fresh)


def _load_files(change: Change, table: Table, paths: list[str], run_ts: datetime, load: int, multi_line: bool) -> None:
    spark = change.warehouse.spark
    raw = read_raw(spark, paths, table, multi_line=multi_line)
    raw = raw.withColumn(FILE, F.col("_metadata.file_path"))
    day = F.regexp_extract(F.col(FILE), r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1).try_cast("date")
    rows = with_verdict(typed(raw.withColumn(DAY, day), table, keep=(DAY, FILE)), table, run_ts, (DAY, FILE))
    change.write(rows_name(table), rows.withColumn(LOAD, F.lit(load).cast("long")), "loaded", by=LOAD, gather=False, only=[str(load)])


def current_rows(warehouse: Warehouse, table: Table) -> DataFrame:
    """All rows, accepted and rejected, of files that were not superseded."""
    rows = warehouse.read(rows_name(table))
    gone = read_ledger(warehouse, table).where("superseded_by IS NOT NULL")
    return rows.join(gone.select(F.col("path").alias(FILE), F.col("load").alias(LOAD)), [FILE, LOAD], "left_anti")


def read_loaded(spark: SparkSession, target: str, table: Table) -> DataFrame:
    """Accepted rows with their day, each file's as it was last loaded."""
    return current_rows(Warehouse(spark, target), table).where(ACCEPTED).select(*table.columns, "_loaded_at", DAY)


def read_loaded_rejects(spark: SparkSession, target: str, table: Table) -> DataFrame:
    rows = current_rows(Warehouse(spark, target), table).where(~F.col(ACCEPTED))
    return rows.select(F.lit(table.name).alias("table_name"), F.col(REASON).alias("reason"), F.col(RAW).alias("raw"), "_loaded_at", DAY)
