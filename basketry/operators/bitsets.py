"""Exact sets of whole numbers as words of 64 bits: they unite by OR, are counted by their bits, and tell members.

A set is a row for each word that has a member, so a sparse set costs a row for each member at most and a
dense one a row for 64. Unlike counts, sets of days or groups can be united to those of a longer period
or a larger group without counting anyone twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD, BITS = "word", "bits"
# A set with more words is not sent to all executors.
MAX_WORDS = 1 << 21


def word_of(member: Column) -> Column:
    return F.shiftright(member.cast("long"), 6)


def bit_of(member: Column) -> Column:
    """The word with the member's bit alone; null for null, which no set has."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), member.cast("long").bitwiseAND(F.lit(63)).cast("int"))


def has(bits: Column, member: Column) -> Column:
    """Whether a member's word (null if the set has none) holds it."""
    return F.coalesce(F.getbit(bits, member.cast("long").bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))


def united(bits: Column | str = BITS) -> Column:
    return F.bit_or(bits)


def size(bits: Column | str = BITS) -> Column:
    """Number of members, as an aggregate over a set's words."""
    return F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("long")


def set_of(df: DataFrame, member: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, word, bits): for each group the set of its members, combined in the map tasks first."""
    known = df.where(F.col(member).isNotNull())
    return known.groupBy(*keys, word_of(F.col(member)).alias(WORD)).agg(united(bit_of(F.col(member))).alias(BITS))


def small_set(df: DataFrame, member: str, max_words: int = MAX_WORDS) -> DataFrame | None:
    """The set of a column's values if its size is bounded, from their range, by ``max_words``; else None."""
    if not isinstance(df.schema[member].dataType, T.IntegralType):
        return None
    low, high = df.agg(F.min(member), F.max(member)).first()
    if low is not None and (high >> 6) - (low >> 6) >= max_words:
        return None
    return set_of(df, member)
