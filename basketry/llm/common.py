"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from basketry.scratch import Scratch, name_local_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEED = 42

# Groups with more than one part in so many of all rows are joined by broadcast: there are fewer
# than PARTS of them, whatever the table's size.
PARTS = 2000
# A filter of hashed keys is a table of at most WORDS rows with 64 bits each.
WORDS = 1 << 18
FILTER_FILES = 8


def scratch(spark: SparkSession) -> Scratch:
    name_local_folder(spark)
    return Scratch(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id, as a long, and the text: other columns can't clash with an operator's own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; the length in bytes stays."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, parts: int = 4) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def attach(rows: DataFrame, groups: DataFrame, on: Sequence[str], size: str, total: int) -> DataFrame:
    """``rows`` that have a group, with the group's columns; ``groups`` has one row for each key.

    ``size`` is the column of ``groups`` with its number of rows, ``total`` the number of all rows.
    Large groups (under ``PARTS`` of them) come by broadcast, so their rows are not gathered; the
    others by a shuffle in which no key has more than one part in ``PARTS`` of the rows. Read twice:
    pass written tables.
    """
    limit = total // PARTS
    extra = [c for c in groups.columns if c not in on]
    # Other names: both sides may stem from one table, and then their columns can't be told apart.
    keyed = groups.select(*[F.col(c).alias(f"_g_{c}") for c in groups.columns])

    def joined(part: DataFrame) -> DataFrame:
        match = reduce(lambda a, b: a & b, (same(F.col(c), F.col(f"_g_{c}")) for c in on))
        return rows.join(part, match).select(*rows.columns, *[F.col(f"_g_{c}").alias(c) for c in extra])

    large = keyed.where(F.col(f"_g_{size}") > limit)
    small = keyed.where(F.col(f"_g_{size}") <= limit)
    return joined(F.broadcast(large)).unionByName(joined(small))


def bits(keys: DataFrame, key: str) -> DataFrame:
    """A filter over the hashed keys (longs): at most ``WORDS`` rows of 64 bits, however many keys there are.

    It never misses a key; with very many keys it lets others pass, which then cost a look, no error.
    """
    return (
        keys.groupBy(word_of(F.col(key)).alias("_word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit_of(F.col(key)))).alias("_bits"))
        .coalesce(FILTER_FILES)
    )


def word_of(key: Column) -> Column:
    return F.pmod(F.shiftright(key, 6), F.lit(WORDS)).cast("int")


def bit_of(key: Column) -> Column:
    return F.pmod(key, F.lit(64)).cast("int")


def flagged(rows: DataFrame, key: Column, filter_table: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean: whether the filter may hold the key. The filter's size is bounded, so it is broadcast."""
    keyed = rows.withColumn("_key", key)
    keyed = keyed.withColumn("_word", word_of(F.col("_key")))
    bit = F.getbit("_bits", bit_of(F.col("_key")))
    return (
        keyed.join(F.broadcast(filter_table), "_word", "left")
        .withColumn(name, F.coalesce(bit == 1, F.lit(False)))
        .drop("_word", "_bits", "_key")
    )


def retain(docs: DataFrame, verdicts: DataFrame, total: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    ``verdicts`` (doc_id, text_hash, n, once): rows with this id and this xxhash64 of the text go, or
    just one of them stays if ``once``; n is their number, ``total`` that of all rows. Rows without a
    verdict stay. Only rows that the bounded filter can't clear are shuffled.
    """
    whole = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col)).alias("_hash")
    )
    keys = verdicts.select(F.xxhash64("doc_id", "text_hash").alias("_k"))
    marked = flagged(whole, F.xxhash64("_id", "_hash"), bits(keys, "_k"), "_maybe")
    doubtful = marked.where("_maybe").drop("_maybe")
    named = verdicts.select(
        F.col("doc_id").alias("_v_id"), F.col("text_hash").alias("_v_hash"), F.col("n").alias("_n"), F.col("once").alias("_once")
    )
    match = same(F.col("_id"), F.col("_v_id")) & (F.col("_hash") == F.col("_v_hash"))
    limit = total // PARTS

    def judged(rows: DataFrame, part: DataFrame) -> DataFrame:
        return rows.join(part, match, "left").select("row", "_id", "_hash", "_once")

    first = judged(doubtful, F.broadcast(named.where(F.col("_n") > limit)))
    rest = judged(first.where("_once IS NULL").drop("_once"), named.where(F.col("_n") <= limit))
    once = first.where("_once").unionByName(rest.where("_once")).dropDuplicates(["_id", "_hash"])
    kept = [marked.where("NOT _maybe"), rest.where("_once IS NULL"), once]
    return reduce(DataFrame.unionByName, (k.select("row.*") for k in kept))


def append_columns(docs: DataFrame, build: Callable[[list[str | None]], dict], schema: str, drop_text: bool = False) -> DataFrame:
    """``docs`` with columns that ``build`` makes of the texts (column ``text``), a slice of rows at a time.

    Columns of ``docs`` that have a new column's name give way. No row moves to another task.
    """
    from basketry.llm.ngrams import slices

    new = T.StructType.fromDDL(schema)
    kept = [f for f in docs.schema.fields if f.name not in new.names and not (drop_text and f.name == "text")]
    out = T.StructType([*kept, *new.fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch):
                part = batch.slice(start, len(texts))
                made = build(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in kept] + [pa.array(made[f.name], to_arrow_type(f.dataType)) for f in new.fields],
                    names=[*(f.name for f in kept), *new.names],
                )

    return docs.mapInArrow(work, out)


def filter_texts(docs: DataFrame, keep: Callable[[list[str | None]], Sequence[bool]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts ``keep`` says yes to. No row moves to another task."""
    from basketry.llm.ngrams import slices

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in slices(batch, text_col):
                yield batch.slice(start, len(part)).filter(pa.array([bool(k) for k in keep(part)], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
