"""A text of every key of a table, such as a product's category, as words of 64 keys with a few bits for each.

Few different texts stand for very many keys. So the words are small enough to be sent to the rows that
ask for them where the table is not, and those rows need not move.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.bitsets import WORD, bit_of, word_of
from basketry.scratch import Scratch

# With more different texts a key would need more than six bits.
MAX_VALUES = 63
_ROWS, _CODE = "_rows", "_code"


@dataclass(frozen=True)
class Lookup:
    """Texts by key. A key's number says which of ``values`` it has, from one on; the planes hold the numbers' bits."""

    words: DataFrame
    planes: tuple[str, ...]
    values: tuple[str | None, ...]

    def join(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """The rows of ``df`` whose key is known, with its text: what an inner join with the table gives.

        Whether the words are sent or shuffled is Spark's size check, as with any join.
        """
        words = self.words.select(F.col(WORD).alias("_word"), *self.planes)
        place = F.col(key).cast("long").bitwiseAND(F.lit(63)).cast("int")
        code = reduce(
            Column.__add__, [F.getbit(F.col(p), place).cast("int") * F.lit(1 << k) for k, p in enumerate(self.planes)]
        )
        value = F.get(F.array(*[F.lit(v).cast("string") for v in self.values]), F.col(_CODE) - 1)
        found = df.join(words, word_of(F.col(key)) == F.col("_word")).withColumn(_CODE, code).where(F.col(_CODE) > 0)
        return found.select(*df.columns, value.alias(name))


def lookup(df: DataFrame, key: str, attribute: str, scratch: Scratch) -> Lookup | None:
    """The lookup of ``attribute`` by ``key``; None if keys repeat or are no whole numbers, or texts are many or all null.

    Rows without a key are left out: no row of a join asks for them. The words are written first, so that
    their size is known.
    """
    if not (isinstance(df.schema[key].dataType, T.IntegralType) and isinstance(df.schema[attribute].dataType, T.StringType)):
        return None
    text = F.col(attribute)
    known = df.where(F.col(key).isNotNull()).select(key, attribute)
    found = [r[0] for r in known.select(attribute).distinct().limit(MAX_VALUES + 1).collect()]
    texts = sorted(v for v in found if v is not None)
    if not texts or len(found) > MAX_VALUES:
        return None
    values = (*texts, None) if len(texts) < len(found) else tuple(texts)
    code = F.when(text.isNull(), len(values)).otherwise(F.array_position(F.array(*[F.lit(v) for v in texts]), text))
    planes = tuple(f"_plane{k}" for k in range(len(values).bit_length()))
    bits = [
        F.bit_or(F.when(F.getbit(F.col(_CODE), F.lit(k)) == 1, bit_of(F.col(key))).otherwise(F.lit(0).cast("long"))).alias(p)
        for k, p in enumerate(planes)
    ]
    coded = known.select(key, code.cast("long").alias(_CODE))
    words = scratch.keep(
        coded.groupBy(word_of(F.col(key)).alias(WORD)).agg(F.count(F.lit(1)).alias(_ROWS), *bits), "words"
    )
    used = F.bit_count(reduce(Column.bitwiseOR, [F.col(p) for p in planes]))
    rows, keys = words.agg(F.sum(_ROWS), F.sum(used)).first()
    return Lookup(words, planes, values) if rows == keys else None
