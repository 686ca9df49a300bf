"""Dated raw files: one folder per table and day, replaced as a whole when a day runs again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basketry.schemas import Table
from basketry.scratch import delete_folder
from basketry.sources.snapshot import partition_date

# Bounds a part file, so that one task can parse it with line breaks inside quotes.
ROWS_PER_FILE = 1_000_000
# Text shrinks to about a fifth. A compressed file is read whole by one task, as its rows allow.
CODEC = "gzip"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ISO_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Quotes are doubled inside quoted fields. Nothing is trimmed or treated as an escape.
CSV_DIALECT = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def raw_table_folder(root: str, table: Table) -> str:
    """Folder of all days: database tables lie together, event logs apart."""
    return f"{root}/raw/events" if table.raw_format == "json" else f"{root}/raw/postgres/{table.name}"


def raw_folder(root: str, table: Table, day: date) -> str:
    return f"{raw_table_folder(root, table)}/{partition_date(day)}"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; null is an empty field, an empty text is a quoted empty field."""
    (
        df.write.mode("overwrite")
        .options(**CSV_DIALECT)
        .option("timestampNTZFormat", TIME_FORMAT)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("compression", CODEC)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, ISO times, nulls kept as fields."""
    (
        df.write.mode("overwrite")
        .option("timestampNTZFormat", ISO_TIME_FORMAT)
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("compression", CODEC)
        .json(path)
    )


def write_raw(df: DataFrame, root: str, table: Table, day: date) -> str | None:
    """Export one snapshot; returns its folder, or None for an empty table, which leaves no folder.

    Rows are counted while they are written, so the source is computed once. A day that was exported
    before and is empty now loses its old files.
    """
    path = raw_folder(root, table, day)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if table.raw_format == "json":
        write_json(counted.withColumn("metadata", parse_metadata(df)), path)
    else:
        write_csv(counted.select(*table.columns), path)
    if seen.get["rows"]:
        return path
    delete_folder(df.sparkSession, path)
    return None


def parse_metadata(df: DataFrame):
    """Event metadata as a semi-structured value, parsed if it still is JSON text.

    Text that is no JSON becomes a text value, so that nothing is lost and no row stops the export.
    """
    value = F.col("metadata")
    is_text = dict(df.dtypes)["metadata"] == "string"
    return F.coalesce(F.try_parse_json(value), value.cast("variant")) if is_text else value
