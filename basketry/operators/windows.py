"""Windows over a whole table: rank, running sum, quantile buckets and total.

A window without PARTITION BY moves every row into one task. Ranks and running sums sort by range
instead, note each row's place inside its range in a written table, and add what the earlier ranges
hold; one row per range reaches the driver. Quantile buckets need no sort (see ``selection``). The
order must be total: end it with a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from basketry.operators import selection
from basketry.operators.ordering import By, asc, desc
from basketry.scratch import Scratch

__all__ = ["By", "asc", "bucket_borders", "desc", "global_ntile", "global_window", "with_total"]

RANGE, PLACE = "_range", "_place"


def _placed(df: DataFrame, order: Sequence[By], scratch: Scratch, columns: Sequence[str]) -> DataFrame:
    """Written copy of ``columns`` in sort order, with each row's range number and place in the range.

    The numbers are stored, so a recomputed sort with other range borders cannot change them.
    """
    place = F.monotonically_increasing_id()
    return scratch.keep(
        df.sort(*[b.order for b in order])
        .withColumn(PLACE, place)
        .withColumn(RANGE, F.shiftright(PLACE, 33))
        .select(*columns, RANGE, (F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(PLACE)),
        "placed",
        # Places go up by one, which this shrinks.
        codec="zstd",
    )


def _starts(placed: DataFrame, sums: Sequence[str]) -> tuple[list[tuple], int]:
    """(range, rows before it, sums before it ...) of every range, in order; and the number of all rows."""
    totals = (
        placed.groupBy(RANGE)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(sums)])
        .collect()
    )
    totals = sorted(totals, key=lambda t: t[0])
    rows = list(accumulate((t["n"] for t in totals), initial=0))
    before = [[None, *accumulate((t[f"s{i}"] for t in totals), _add)] for i in range(len(sums))]
    return [(t[RANGE], rows[k], *(b[k] for b in before)) for k, t in enumerate(totals)], rows[-1]


def _local(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame whose size Spark knows, so that it decides on a broadcast by its size limit."""
    fields = StructType.fromDDL(schema)
    columns = zip(*rows) if rows else ([] for _ in fields)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=fields.names), fields)


def _add(a, b):
    """Sum in which null is no value, as in SQL."""
    if a is None or b is None:
        return b if a is None else a
    return a + b


def global_window(
    df: DataFrame,
    order: Sequence[By],
    scratch: Scratch,
    rank: str | None = None,
    running: dict[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add a row number over the whole table and running sums, from one sort.

    ``running`` maps the name of a running sum to its column. Running sums want decimals or
    integers: addition then gives the same result in any grouping. ``columns`` are those the caller
    wants back, all by default: others only settle the order and are not written.
    """
    running = running or {}
    columns = df.columns if columns is None else list(columns)
    placed = _placed(df, order, scratch, list(dict.fromkeys([*columns, *running.values()])))
    sum_types = {n: placed.agg(F.sum(c)).schema[0].dataType for n, c in running.items()}
    schema = ", ".join(
        [f"{RANGE} long", "_rows long", *[f"_s{i} {sum_types[n].simpleString()}" for i, n in enumerate(running)]]
    )
    starts = _local(df.sparkSession, _starts(placed, list(running.values()))[0], schema)
    if running:
        inside = (
            Window.partitionBy(RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
        )
        placed = placed.withColumns({n: F.sum(c).over(inside) for n, c in running.items()})
    joined = placed.join(starts, RANGE)
    out = [F.col(c) for c in columns]
    if rank:
        out.append((F.col("_rows") + F.col(PLACE)).alias(rank))
    for i, n in enumerate(running):
        start = F.col(f"_s{i}")
        out.append(F.coalesce(start + F.col(n), start, F.col(n)).cast(sum_types[n]).alias(n))
    return joined.select(*out)


def bucket_borders(n: int, buckets: int) -> list[int]:
    """Ranks of the last row of every bucket but the last, when ``n`` rows are dealt out evenly."""
    small, larger = divmod(n, buckets)
    ends = accumulate([small + 1] * larger + [small] * (buckets - larger))
    return [e for e in dict.fromkeys(ends) if e < n]


def global_ntile(df: DataFrame, buckets: int, scores: dict[str, Sequence[By]]) -> DataFrame:
    """Add one NTILE column per entry of ``scores``, each over its own order.

    The rows at the bucket borders are found by histograms that are refined around them, and every row
    gets its scores by comparing with these: the table is neither sorted nor shuffled nor joined. The
    sort columns must be whole numbers, decimals, dates or times. ``df`` should be a written table.
    """
    wanted = list(dict.fromkeys(b.column for order in scores.values() for b in order))
    at = selection.positions(df, wanted)
    orders = list(scores.values())
    found = selection.borders(df, orders, [bucket_borders(at.rows, buckets)] * len(orders), at)
    return df.withColumns(
        {name: _score([at.of(b) for b in order], own) for (name, order), own in zip(scores.items(), found, strict=True)}
    )


def _score(columns: Sequence[Column], borders: Sequence[tuple[int, ...]]) -> Column:
    """One more than the number of borders a row comes after."""
    score = F.lit(1)
    for bucket, border in reversed(list(enumerate(borders, start=1))):
        inside = F.when(~selection.after(columns, border), bucket)
        score = inside.otherwise(bucket + 1 if bucket == len(borders) else score)
    return score


def with_total(df: DataFrame, name: str, source: DataFrame, value: str) -> DataFrame:
    """Add the sum of ``value`` over the whole of ``source`` to each row.

    A one-value subquery: no window, which would move every row into one task, and no join.
    """
    return df.withColumn(name, source.agg(F.sum(value)).scalar())
