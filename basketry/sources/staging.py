"""Staging tables: daily snapshots side by side, and the latest row of every key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import Table
from basketry.scratch import Scratch

DAY = "ingest_date"
# Accepted rows and rejects of a day lie in two folders that one job writes.
ACCEPTED = "accepted"
REASON, RAW = "_reason", "_raw"


def staging_path(root: str, table: Table) -> str:
    return f"{root}/staging/{table.name}"


def day_path(root: str, table: Table, day: date) -> str:
    return f"{staging_path(root, table)}/{DAY}={day.isoformat()}"


def write_both(rows: DataFrame, path: str) -> None:
    """Accepted rows and rejects, side by side, from one pass over ``rows``; what was there goes."""
    rows.write.mode("overwrite").partitionBy(ACCEPTED).parquet(path, compression="zstd")


def append_staging(df: DataFrame, root: str, table: Table, day: date) -> None:
    """Add a day's rows. Loading the same day again replaces that day and leaves the others."""
    write_both(df.withColumn(ACCEPTED, F.lit(True)), day_path(root, table, day))


def staging_schema(table: Table) -> T.StructType:
    return table.schema.add("_loaded_at", T.TimestampNTZType()).add(DAY, T.DateType())


def read_accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    found = T.StructType([*schema, T.StructField(ACCEPTED, T.BooleanType())])
    return spark.read.schema(found).parquet(path).where(ACCEPTED).select(*schema.names)


def read_rejected(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """Rows left out: what they held, why they were left out, and when; with the day of each."""
    found = f"_loaded_at timestamp_ntz, {REASON} string, {RAW} string, {DAY} date, {ACCEPTED} boolean"
    return (
        spark.read.schema(found)
        .parquet(path)
        .where(~F.col(ACCEPTED))
        .select(F.lit(table.name).alias("table_name"), F.col(REASON).alias("reason"), F.col(RAW).alias("raw"), "_loaded_at", DAY)
    )


def read_rejects(spark: SparkSession, root: str, table: Table, day: date) -> DataFrame:
    """Rows a day's load left out."""
    return read_rejected(spark, staging_path(root, table), table).where(F.col(DAY) == F.lit(day)).drop(DAY)


def read_staging(spark: SparkSession, root: str, table: Table, day: date | None = None) -> DataFrame:
    """All loaded days, or one: the day is a folder, so other days are not read."""
    df = read_accepted(spark, staging_path(root, table), staging_schema(table))
    return df if day is None else df.where(F.col(DAY) == F.lit(day)).drop(DAY)


# --- the newest row of every key ---------------------------------------------------------------

NEWEST = (DAY, "_loaded_at")
_KEY, _RANK, _BEST, _TOP, _ROWS, _THERE = "_key", "_rank", "_best", "_top", "_rows", "_there"


def content_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.to_json(c) if t == "variant" else F.col(c) for c, t in df.dtypes])


def ranked(df: DataFrame, key: str, newest: tuple[str, ...] = NEWEST) -> DataFrame:
    """Key and rank of the rows that have a key; of two rows the newer ranks higher, equally new ones by content."""
    rank = F.struct(*[F.col(c) for c in newest if c in df.columns], content_hash(df).alias("hash"))
    return df.select(F.col(key).alias(_KEY), rank.alias(_RANK)).where(F.col(_KEY).isNotNull())


def best_ranks(ranks: DataFrame) -> DataFrame:
    """The highest rank of every key, and how many rows it has at the newest moment of all: a state of the table."""
    moment = F.col(_RANK)[ranks.schema[_RANK].dataType[0].name]
    at_newest = F.count_if(moment.eqNullSafe(ranks.agg(F.max(moment)).scalar()))
    return ranks.groupBy(_KEY).agg(F.max(_RANK).alias(_BEST), at_newest.alias(_ROWS))


def rows_of_best(
    df: DataFrame,
    best: DataFrame,
    key: str,
    newest: tuple[str, ...] = NEWEST,
    scratch: Scratch | None = None,
    moment: Column | None = None,
) -> DataFrame:
    """The rows of ``df`` that ``best`` says are the newest of their keys, and all rows without a key.

    A key that has one row at the newest moment of all, as nearly every key of a full snapshot has, is
    no exception: its row stays where it is. Joined are only rows of that moment whose key has several
    there, and earlier rows of keys that have none. With a ``scratch`` these exceptions are written
    first, so that their size is known and few of them are sent to the rows, not the rows to them.
    ``moment`` is the newest one, if it is known without a look at ``best``.
    """
    order = [c for c in newest if c in df.columns]
    moment = best.agg(F.max(F.col(_BEST)[order[0]])).scalar() if moment is None else moment
    there = F.col(_BEST)[order[0]].eqNullSafe(moment)
    exceptions = best.where(~there | (F.col(_ROWS) != 1)).select(F.col(_KEY), F.col(_BEST), there.alias(_THERE))
    exceptions = scratch.keep(exceptions, "exceptions") if scratch else exceptions
    repeated, behind = (exceptions.where(which).drop(_THERE) for which in (F.col(_THERE), ~F.col(_THERE)))
    keyed = df.where(F.col(key).isNotNull())
    is_newest = F.col(order[0]).eqNullSafe(moment)
    latest = keyed.where(is_newest)
    simple = latest.join(repeated.select(F.col(_KEY).alias(key)), key, "left_anti")
    rank = F.struct(*[F.col(c) for c in order], content_hash(df).alias("hash"))

    def looked_up(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        found = rows.withColumn(_RANK, rank).join(wanted, F.col(key) == F.col(_KEY))
        return found.where(F.col(_RANK).eqNullSafe(F.col(_BEST))).select(*df.columns)

    # Rows that rank equal are equal: one of them stays.
    found = looked_up(latest, repeated).unionByName(looked_up(keyed.where(~is_newest), behind))
    whole_row = F.struct(*[F.col(c) for c in df.columns])
    once = found.groupBy(key).agg(F.first(whole_row).alias("_row")).select("_row.*")
    return simple.select(*df.columns).unionByName(once).unionByName(df.where(F.col(key).isNull()))


def latest_snapshot(
    df: DataFrame, key: str = "id", newest: tuple[str, ...] = NEWEST, scratch: Scratch | None = None
) -> DataFrame:
    """The newest row of every key; rows without a key are all kept, since nothing says which belong together.

    Keys, moments and hashes of the rows are shuffled, not the rows: see ``rows_of_best``. Each task
    reduces its rows to one per key first, so a key with very many copies stays cheap.
    """
    first = next(c for c in newest if c in df.columns)
    moment = df.where(F.col(key).isNotNull()).agg(F.max(first)).scalar()
    return rows_of_best(df, best_ranks(ranked(df, key, newest)), key, newest, scratch, moment)


def merge_state(state: DataFrame | None, day_rows: DataFrame, key: str = "id", newest: tuple[str, ...] = NEWEST) -> DataFrame:
    """The state after one more day: (key, highest rank, rows at its moment), from the state before and the day alone.

    No earlier day is read. Rows of a day that is loaded again are newer by their load time; if it has lost
    keys by that, build the state anew from all days.
    """
    fresh = best_ranks(ranked(day_rows, key, newest))
    if state is None:
        return fresh
    both = state.unionByName(fresh)
    moment = both.schema[_BEST].dataType[0].name
    top = F.max(F.struct(F.col(_BEST), F.col(_ROWS)))
    merged = both.groupBy(_KEY).agg(top.alias(_TOP), F.count(F.lit(1)).alias("_n"), F.min(F.col(_BEST)[moment]).alias("_low"))
    # The same day twice: both loads' rows are there to be told apart.
    again = (F.col("_n") > 1) & F.col("_low").eqNullSafe(F.col(f"{_TOP}.{_BEST}")[moment])
    rows = F.when(again, F.lit(2).cast("long")).otherwise(F.col(f"{_TOP}.{_ROWS}"))
    return merged.select(_KEY, F.col(f"{_TOP}.{_BEST}").alias(_BEST), rows.alias(_ROWS))
