"""Rows at given ranks of a whole table, found by refined histograms instead of a sort.

Each sort column becomes a position: a whole number that grows in sort order. One pass counts the
rows in so many equal ranges of positions, the next looks only at the ranges that hold a wanted rank,
and so on; ties go on with the next column. No row is shuffled: a task sends its counts, and a range
with few rows left sends those. The number of passes depends on the logarithm of the value range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.ordering import By

# Ranges counted at once for one wanted rank, and rows that are fetched rather than counted once more.
RANGES = 1024
FETCH = 4096


COUNTED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampNTZType, T.TimestampType)


def _whole(name: str, data_type: T.DataType) -> Column:
    """The value as a whole number of its type's smallest unit."""
    c = F.col(name)
    if isinstance(data_type, T.DecimalType):
        return (c.cast("decimal(38,%d)" % data_type.scale) * F.lit(10**data_type.scale)).cast("decimal(38,0)")
    if isinstance(data_type, T.DateType):
        return F.unix_date(c).cast("decimal(38,0)")
    if isinstance(data_type, T.TimestampNTZType):
        minutes = (F.unix_date(F.to_date(c)).cast("decimal(38,0)") * 24 + F.hour(c)) * 60 + F.minute(c)
        micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("decimal(38,0)")
        return (minutes * 60_000_000 + micros).cast("decimal(38,0)")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(c).cast("decimal(38,0)")
    return c.cast("decimal(38,0)")


def _number(value: int) -> Column:
    return F.lit(value) if abs(value) < 1 << 62 else F.lit(str(value)).cast("decimal(38,0)")


@dataclass(frozen=True)
class Positions:
    """Positions of one table's columns: from 0 (the lowest) to ``spans[column]``, nulls one above that."""

    types: dict[str, T.DataType]
    lows: dict[str, int]
    spans: dict[str, int]
    rows: int

    def of(self, by: By) -> Column:
        low, span = self.lows[by.column], self.spans[by.column]
        kind = "long" if span < 1 << 62 else "decimal(38,0)"
        above = (_whole(by.column, self.types[by.column]) - _number(low)).cast(kind)
        up = F.coalesce(above, _number(span + 1).cast(kind))
        return (_number(span + 1) - up).cast(kind) if by.descending else up


def positions(df: DataFrame, columns: Sequence[str]) -> Positions:
    """One pass: the number of rows, and the lowest and highest value of each column."""
    types = {f.name: f.dataType for f in df.schema if f.name in columns}
    names = list(types)
    if other := [c for c in names if not isinstance(types[c], COUNTED)]:
        raise TypeError(f"no whole numbers, decimals, dates or times: {', '.join(other)}")
    ends = [f(_whole(c, types[c])).alias(f"{f.__name__}{k}") for k, c in enumerate(names) for f in (F.min, F.max)]
    found = df.agg(F.count(F.lit(1)).alias("rows"), *ends).first()
    lows = {c: int(found[f"min{k}"] or 0) for k, c in enumerate(names)}
    return Positions(types, lows, {c: int(found[f"max{k}"] or 0) - lows[c] for k, c in enumerate(names)}, found["rows"])


@dataclass(frozen=True)
class Cell:
    """Rows of an order whose first columns have these positions, and whose next one lies in a range."""

    order: int
    tied: tuple[int, ...]
    low: int
    high: int

    def holds(self, columns: Sequence[Column]) -> Column:
        c = columns[len(self.tied)]
        ties = [columns[k] == _number(v) for k, v in enumerate(self.tied)]
        return reduce(Column.__and__, [*ties, c >= _number(self.low), c <= _number(self.high)])


@dataclass(frozen=True)
class _Search:
    """A wanted rank (from 1) among the rows of a cell; ``rows`` is how many these are."""

    key: tuple[int, int]
    cell: Cell
    rank: int
    rows: int


def borders(df: DataFrame, orders: Sequence[Sequence[By]], ranks: Sequence[Sequence[int]], at: Positions) -> list[list[tuple[int, ...]]]:
    """For each order and each of its wanted ranks (from 1 to the number of rows) the positions of the row there.

    Rows that tie in every column have equal positions. ``df`` is read several times: pass a written
    table. All orders are searched in the same passes.
    """
    columns = [[at.of(b) for b in order] for order in orders]
    tops = [[at.spans[b.column] + 1 for b in order] for order in orders]
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    few: list[_Search] = []
    todo = [
        _Search((o, k), Cell(o, (), 0, tops[o][0]), rank, at.rows) for o, own in enumerate(ranks) for k, rank in enumerate(own)
    ]
    while todo:
        counted = _count(df, [s.cell for s in todo if s.rows > FETCH], columns)
        ahead = []
        for s in todo:
            if s.rows <= FETCH:
                few.append(s)
                continue
            s = _narrowed(s, counted[s.cell])
            cell, last = s.cell, len(tops[s.cell.order]) - 1
            if cell.low < cell.high:
                ahead.append(s)
            elif len(cell.tied) == last:
                found[s.key] = (*cell.tied, cell.low)
            else:
                tied = (*cell.tied, cell.low)
                ahead.append(replace(s, cell=Cell(cell.order, tied, 0, tops[cell.order][len(tied)])))
        todo = ahead
    rows = _fetch(df, [s.cell for s in few], columns)
    found.update((s.key, rows[s.cell][s.rank - 1]) for s in few)
    return [[found[o, k] for k in range(len(own))] for o, own in enumerate(ranks)]


def _width(cell: Cell) -> int:
    return -(-(cell.high - cell.low + 1) // RANGES)


def _count(df: DataFrame, cells: Sequence[Cell], columns) -> dict[Cell, dict[int, int]]:
    """How many rows each range of each cell has: cells times RANGES numbers at most."""
    cells = list(dict.fromkeys(cells))
    if not cells:
        return {}
    inside = []
    for k, cell in enumerate(cells):
        c = columns[cell.order][len(cell.tied)]
        number = F.call_function("div", c - _number(cell.low), _number(_width(cell)))
        inside.append(F.when(cell.holds(columns[cell.order]), F.struct(F.lit(k).alias("cell"), number.cast("int").alias("range"))))
    each = df.select(F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())).alias("at")).select("at.*")
    out: dict[Cell, dict[int, int]] = {c: {} for c in cells}
    for r in each.groupBy("cell", "range").agg(F.count(F.lit(1)).alias("n")).collect():
        out[cells[r["cell"]]][r["range"]] = r["n"]
    return out


def _narrowed(s: _Search, counts: dict[int, int]) -> _Search:
    """The same search within the one range that holds the rank."""
    before = 0
    for number in sorted(counts):
        if before + counts[number] >= s.rank:
            low = s.cell.low + number * _width(s.cell)
            cell = replace(s.cell, low=low, high=min(low + _width(s.cell) - 1, s.cell.high))
            return replace(s, cell=cell, rank=s.rank - before, rows=counts[number])
        before += counts[number]
    raise ValueError(f"rank {s.rank} of {before} rows")


def _fetch(df: DataFrame, cells: Sequence[Cell], columns) -> dict[Cell, list[tuple[int, ...]]]:
    """The positions of all rows of each cell, in order: cells times FETCH rows at most."""
    cells = list(dict.fromkeys(cells))
    if not cells:
        return {}
    inside = [
        F.when(
            cell.holds(columns[cell.order]),
            F.struct(F.lit(k).alias("cell"), F.array(*[c.cast("decimal(38,0)") for c in columns[cell.order]]).alias("position")),
        )
        for k, cell in enumerate(cells)
    ]
    out: dict[Cell, list[tuple[int, ...]]] = {c: [] for c in cells}
    for r in df.select(F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())).alias("at")).select("at.*").collect():
        out[cells[r["cell"]]].append(tuple(map(int, r["position"])))
    return {c: sorted(rows) for c, rows in out.items()}


def after(columns: Sequence[Column], border: Sequence[int]) -> Column:
    """Whether a row, given the positions of its sort columns, comes after the border."""
    first, value = columns[0], _number(border[0])
    if len(columns) == 1:
        return first > value
    return (first > value) | ((first == value) & after(columns[1:], border[1:]))
