"""Rows at given ranks, found by refined histograms: they are those of a full sort."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import selection as s
from basketry.operators.ordering import asc, desc

SCHEMA = "money decimal(22,2), small int, big long, day date, moment timestamp_ntz, key long"


@pytest.fixture(scope="module")
def rows():
    out = []
    for k in range(700):
        moment = datetime(1969, 1, 1) + timedelta(days=k * 37 % 600, microseconds=k * 7919 % 1_000_003)
        out.append((
            None if k % 11 == 0 else Decimal(k * 7919 % 997) / 100 - 3,
            None if k % 13 == 0 else k % 3,
            (-1) ** k * (1 << 62) + k if k % 50 == 0 else k * 104729 % 1009,
            None if k % 17 == 0 else moment.date(),
            None if k % 19 == 0 else moment,
            k,
        ))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


ORDERS = [
    [asc("money"), asc("key")],
    [desc("money"), desc("key")],
    [asc("small"), desc("big"), asc("key")],
    [desc("big"), asc("key")],
    [asc("day"), asc("key")],
    [desc("moment"), asc("key")],
]


@pytest.mark.parametrize(("ranges", "fetch"), [(1024, 4096), (4, 3), (2, 0)])
def test_borders_are_the_rows_of_a_full_sort(table, rows, monkeypatch, ranges, fetch):
    monkeypatch.setattr(s, "RANGES", ranges)
    monkeypatch.setattr(s, "FETCH", fetch)
    at = s.positions(table, [f.split()[0] for f in SCHEMA.split(", ")])
    wanted = [1, 2, 350, 699, 700]
    found = s.borders(table, ORDERS, [wanted] * len(ORDERS), at)
    for order, own in zip(ORDERS, found, strict=True):
        columns = [at.of(b) for b in order]
        names = [f"p{k}" for k in range(len(order))]
        full = table.sort(*[b.order for b in order]).select(*[c.alias(n) for c, n in zip(columns, names, strict=True)])
        want = [tuple(map(int, r)) for r in full.collect()]
        assert want == sorted(want)
        assert own == [want[r - 1] for r in wanted]


def test_rows_after_a_border(table):
    at = s.positions(table, ["money", "key"])
    order = [desc("money"), asc("key")]
    ((border,),) = s.borders(table, [order], [[70]], at)
    later = table.where(~s.after([at.of(b) for b in order], border)).select("key")
    assert sorted(later.collect()) == sorted(table.sort(*[b.order for b in order]).limit(70).select("key").collect())


def test_many_equal_rows(spark):
    df = spark.range(5000).select(F.lit(7).alias("a"), (F.col("id") % 2).alias("b"))
    at = s.positions(df, ["a", "b"])
    assert s.borders(df, [[asc("a"), desc("b")]], [[2500, 2501]], at) == [[(0, 1), (0, 2)]]


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError, match="name"):
        s.positions(spark.createDataFrame([("x",)], "name string"), ["name"])
