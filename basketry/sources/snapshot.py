"""Reading whole tables: Parquet files or an operational database."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from basketry.schemas import Table

EXPORT_EVENTS = ("id", "user_id", "event_type", "event_ts", "metadata")


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_options(
    url: str, table: Table, lower: int, upper: int, partitions: int, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Reader options that split a table scan into id ranges, one connection each.

    ``lower`` and ``upper`` only place the cuts: ids outside them fall into the end ranges, so no
    row is lost. Without the cuts one task would pull the whole table.
    """
    return {
        "url": url,
        "dbtable": table.name,
        "partitionColumn": "id",
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
    }


def read_jdbc(
    spark: SparkSession, url: str, table: Table, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """Snapshot scan of an operational table, as parallel id ranges."""
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, table, lower, upper, partitions), **options)
        .load()
        .select(*table.columns)
    )


def scan_events(events: DataFrame) -> DataFrame:
    """The event columns that leave the operational system; others are pruned from the scan."""
    return events.select(*EXPORT_EVENTS)


def partition_date(day: date) -> str:
    """Folder name of a daily snapshot."""
    return day.isoformat()
