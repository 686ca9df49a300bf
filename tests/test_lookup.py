"""Texts by key in words of 64 keys: the rows of a join, or no lookup where words can't tell."""

from __future__ import annotations

import pytest

from basketry.operators import lookup as l
from basketry.scratch import Scratch

DIM = "key long, name string, other int"
TEXTS = ("a", "b", None, "", "e")


def dim(spark, rows):
    return spark.createDataFrame(rows, DIM).repartition(3)


@pytest.mark.parametrize("texts", [("a",), ("a", "b"), TEXTS, tuple(f"t{k}" for k in range(l.MAX_VALUES))])
def test_rows_are_those_of_the_join(spark, texts):
    keys = [-130, -64, -1, 0, 1, 62, 63, 64, 65, 2**40, 2**63 - 1, -(2**63), *range(200, 400)]
    d = dim(spark, [(k, texts[n % len(texts)], n) for n, k in enumerate(keys)] + [(None, "nobody", 0)])
    asked = [*keys[:30], None, 2, 199, 400, -129, 7, 7, 0, 0]
    rows = spark.createDataFrame([(n, k) for n, k in enumerate(asked)], "id int, key long")
    got = l.lookup(d, "key", "name", Scratch(spark)).join(rows, "key", "name")
    want = rows.join(d.select("key", "name"), "key").select("id", "key", "name")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_table_that_words_can_not_tell_has_none(spark):
    scratch = Scratch(spark)
    assert l.lookup(dim(spark, [(1, "a", 0), (1, "a", 0)]), "key", "name", scratch) is None, "a key that repeats"
    assert l.lookup(dim(spark, [(1, "a", 0), (1, "b", 0)]), "key", "name", scratch) is None
    assert l.lookup(dim(spark, [(1, None, 0)]), "key", "name", scratch) is None
    assert l.lookup(dim(spark, []), "key", "name", scratch) is None
    assert l.lookup(dim(spark, [(k, f"t{k}", 0) for k in range(l.MAX_VALUES + 1)]), "key", "name", scratch) is None
    assert l.lookup(dim(spark, [(1, "a", 0)]), "name", "name", scratch) is None
    assert l.lookup(dim(spark, [(1, "a", 0)]), "key", "other", scratch) is None
    assert l.lookup(dim(spark, [(1, "a", 0), (None, "a", 0), (None, "b", 0)]), "key", "name", scratch) is not None
