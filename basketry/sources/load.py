"""Raw files to typed staging rows; rows that do not fit become rejects with a reason."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import null_tokens, ntz
from basketry.schemas import NOW, Table
from basketry.sources.raw import CSV_DIALECT
from basketry.sources.staging import ACCEPTED, RAW, REASON, write_both

CORRUPT = "_corrupt_record"

# Texts that stand for null, in the load command and in the named file format.
NULL_TOKENS = ("", "NULL")
NULL_TOKENS_WIDE = ("", "NULL", "null")


def csv_options() -> dict[str, str]:
    return {
        **CSV_DIALECT,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # Every field must be parsed for a short row to be noticed, whatever a query selects later.
        "columnPruning": "false",
        "nullValue": "",
        "enforceSchema": "true",
    }


def raw_schema(table: Table) -> T.StructType:
    return table.text_schema.add(CORRUPT, T.StringType())


def read_raw_csv(spark: SparkSession, path: str, table: Table, *, multi_line: bool, **options: str) -> DataFrame:
    """All columns as text. The caller says whether line breaks may occur inside quotes: without them
    a file is split between tasks, with them a task reads a file whole."""
    return (
        spark.read.schema(raw_schema(table))
        .options(**csv_options())
        .option("multiLine", str(multi_line).lower())
        .options(**options)
        .csv(path)
    )


def read_raw_json(spark: SparkSession, path: str, table: Table, multi_line: bool = False) -> DataFrame:
    """Records as text columns plus semi-structured ones. Records stand one per line or in an array;
    an array spread over several lines needs ``multi_line``."""
    return (
        spark.read.schema(raw_schema(table))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", str(multi_line).lower())
        .json(path)
    )


def read_raw(spark: SparkSession, path: str, table: Table, **options) -> DataFrame:
    read = read_raw_json if table.raw_format == "json" else read_raw_csv
    return read(spark, path, table, **options)


def apply_null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Replace null tokens in every text column."""
    texts = [c for c, t in df.dtypes if t == "string" and c != CORRUPT]
    return df.withColumns({c: null_tokens(F.col(c), tokens) for c in texts})


def parsed(text: Column, data_type: T.DataType) -> Column:
    """Text as a typed value, null if it is none. Numbers may have more decimals than the type if those
    are zero, as in ``12.0`` for a whole number; any other would be lost, so the value does not fit."""
    if isinstance(data_type, (T.LongType, T.IntegerType, T.DecimalType)):
        exact = text.try_cast("decimal(38,10)")
        value = exact.try_cast(data_type)
        fits = F.when(exact == value, value)
        return fits if isinstance(data_type, T.DecimalType) else F.coalesce(text.try_cast(data_type), fits)
    return text.try_cast(data_type)


def typed(
    df: DataFrame, table: Table, tokens: Sequence[str] = NULL_TOKENS, keep: Sequence[str] = ()
) -> DataFrame:
    """Cast raw text to the table's types and note in ``_reason`` why a row does not fit.

    The reason is null for a good row. Casting is tried per column, not left to the reader: the
    reader parses only the columns a query needs, so its verdict on a row would change with the query.
    """
    text = apply_null_tokens(df, tokens)
    reasons, columns = [], []
    for f in table.schema:
        c = F.col(f.name)
        if f.dataType in (T.StringType(), T.VariantType()):
            columns.append(c)
            if f.name in table.lengths:
                reasons.append(F.when(F.length(c) > table.lengths[f.name], F.lit(f.name)))
            continue
        value = parsed(c, f.dataType)
        columns.append(value.alias(f.name))
        reasons.append(F.when(c.isNotNull() & value.isNull(), F.lit(f.name)))
    bad_columns = F.concat_ws(",", *reasons)
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed record").when(
        bad_columns != "", F.concat(F.lit("bad value: "), bad_columns)
    )
    raw = F.coalesce(CORRUPT, F.to_json(F.struct(*[F.col(c) for c in table.columns])))
    return text.select(*columns, *keep, reason.alias(REASON), F.when(reason.isNotNull(), raw).alias(RAW))


def accepted(rows: DataFrame, table: Table, run_ts: datetime, keep: Sequence[str] = ()) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).select(*table.columns, ntz(run_ts).alias("_loaded_at"), *keep)


def rejected(rows: DataFrame, table: Table, run_ts: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Rows left out of staging: what they held, why they were left out, and when."""
    return rows.where(F.col(REASON).isNotNull()).select(
        F.lit(table.name).alias("table_name"),
        F.col(REASON).alias("reason"),
        F.col(RAW).alias("raw"),
        ntz(run_ts).alias("_loaded_at"),
        *keep,
    )


def load_typed(
    spark: SparkSession, path: str, table: Table, tokens: Sequence[str] = NULL_TOKENS, **options
) -> DataFrame:
    """All rows of a raw folder, typed, with the reason why a row does not fit."""
    return typed(read_raw(spark, path, table, **options), table, tokens)


def load(
    spark: SparkSession, path: str, table: Table, run_ts: datetime, tokens: Sequence[str] = NULL_TOKENS, **options
) -> tuple[DataFrame, DataFrame]:
    """Staging rows and rejects of one raw folder. Together they are all rows of the files."""
    rows = load_typed(spark, path, table, tokens, **options)
    return accepted(rows, table, run_ts), rejected(rows, table, run_ts)


def nothing_loaded(spark: SparkSession, table: Table) -> DataFrame:
    """Typed rows of a table that exported no file."""
    schema = T.StructType(list(table.schema)).add(REASON, T.StringType()).add(RAW, T.StringType())
    return spark.createDataFrame([], schema)


def with_verdict(rows: DataFrame, table: Table, run_ts: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Accepted rows and rejects in one table; a reject has its reason and raw text, and no values."""
    accepted = F.col(REASON).isNull()
    values = [F.when(accepted, F.col(c)).alias(c) for c in table.columns]
    return rows.select(*values, ntz(run_ts).alias("_loaded_at"), *keep, REASON, RAW, accepted.alias(ACCEPTED))


def write_loaded(rows: DataFrame, table: Table, run_ts: datetime, path: str, keep: Sequence[str] = ()) -> int:
    """Write typed rows below ``path``, accepted ones and rejects apart; returns the number of rejects.

    One job parses the files, counts the rejects and writes both.
    """
    seen = Observation()
    watched = rows.observe(seen, F.count_if(F.col(REASON).isNotNull()).alias("bad"))
    write_both(with_verdict(watched, table, run_ts, keep), path)
    return seen.get["bad"]


def apply_defaults(df: DataFrame, table: Table, run_ts: datetime, fill_nulls: bool = False) -> DataFrame:
    """Add the columns an input lacks: its default, or null without one.

    As in an insert, a default fills an absent column and not an explicit null; ``fill_nulls``
    extends it to nulls.
    """

    def column(f: T.StructField) -> Column:
        default = table.defaults.get(f.name)
        filler = ntz(run_ts) if default is NOW else F.lit(default)
        filler = filler.cast(f.dataType)
        if f.name not in df.columns:
            return filler.alias(f.name)
        kept = F.col(f.name)
        return F.coalesce(kept, filler).alias(f.name) if fill_nulls and default is not None else kept

    return df.select(*[column(f) for f in table.schema])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
