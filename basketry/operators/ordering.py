"""Sort orders that treat null as the highest value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class By:
    """One sort column. Nulls count as the highest value: last ascending, first descending."""

    column: str
    descending: bool = False

    @property
    def order(self) -> Column:
        c = F.col(self.column)
        return c.desc_nulls_first() if self.descending else c.asc_nulls_last()

    def before(self, border: Column) -> Column:
        """Whether a row sorts strictly before the border value; never null."""
        c = F.col(self.column)
        low, high = (border, c) if self.descending else (c, border)
        return F.coalesce(low < high, low.isNotNull() & high.isNull())


def asc(column: str) -> By:
    return By(column)


def desc(column: str) -> By:
    return By(column, descending=True)
