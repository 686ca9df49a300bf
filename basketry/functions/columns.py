"""Column expressions shared by the models; every one stays a built-in expression."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
MONEY_SUM = "decimal(22,2)"
MARGIN_SUM = "decimal(24,3)"


def ntz(value: date | datetime) -> Column:
    """A zone-free timestamp literal; going through text keeps the session zone out of it."""
    moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day_diff(start: Column, end: Column) -> Column:
    """Date boundaries between two moments: 23:00 to 01:00 the next day is one day."""
    return F.datediff(end, start).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null where the denominator is zero or null."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean(value: Column) -> Column:
    """Mean of a decimal column as a double: the exact sum, divided once."""
    return ratio(F.sum(value), F.count(value))


def first_match(rules: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds; a null condition does not hold."""
    rules = iter(rules)
    condition, label = next(rules)
    ladder = F.when(condition, label)
    for condition, label in rules:
        ladder = ladder.when(condition, label)
    return ladder.otherwise(otherwise)


def null_tokens(value: Column, tokens: Iterable[str]) -> Column:
    """Null where the text is one of the tokens that stand for a missing value."""
    return F.when(~value.isin(*tokens), value)


def stamp(df, run_ts: datetime, name: str = "_loaded_at"):
    """Add the load time: one value for the whole run."""
    return df.withColumn(name, ntz(run_ts))
