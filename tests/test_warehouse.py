"""Versions of tables: all switch at once, old ones stay readable, single days are replaced."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from basketry import marks, warehouse
from basketry.warehouse import Warehouse


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def numbers(spark, n, value=0):
    day = F.expr("date_add(date'2024-01-30', cast(id % 4 as int))")
    return spark.range(n).select("id", F.lit(value).alias("value"), day.alias("day"))


def sums(df):
    return {r.day: (r.n, r.v) for r in df.groupBy("day").agg(F.count("*").alias("n"), F.sum("value").alias("v")).collect()}


def test_marks_are_created_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/a/b/one.json"
    assert marks.get(spark, path) is None and marks.names(spark, f"{tmp_path}/a") == []
    marks.put(spark, path, "é 1")
    with pytest.raises(FileExistsError):
        marks.put(spark, path, "2")
    assert marks.get(spark, path) == "é 1" and marks.names(spark, f"{tmp_path}/a/b") == ["one.json"]
    assert not [p for p in (tmp_path / "a" / "b").iterdir() if p.name.startswith("_")], "drafts do not stay"


def test_all_tables_switch_at_once(spark, store):
    assert store.version() == 0 and store.tables() == {}
    first = store.change()
    first.write("a", numbers(spark, 8, 1))
    first.write("b", numbers(spark, 8, 1))
    assert store.tables() == {}, "nothing is visible before the commit"
    assert first.commit() == 1
    second = store.change()
    second.write("a", numbers(spark, 4, 2))
    assert store.read("a").count() == 8
    second.write("b", numbers(spark, 4, 2))
    old = store.read("a")
    assert second.commit() == 2
    assert (store.read("a").count(), store.read("b").count()) == (4, 4)
    assert old.count() == 8 and store.read("b", version=1).count() == 8, "a reader keeps its version"


@pytest.mark.parametrize("fails_at", ["write", "commit"])
def test_a_run_that_fails_leaves_the_whole_old_set(spark, store, monkeypatch, fails_at):
    change = store.change()
    for name in ("a", "b"):
        change.write(name, numbers(spark, 8, 1))
    change.commit()
    change = store.change()
    change.write("a", numbers(spark, 4, 2))
    if fails_at == "write":
        with pytest.raises(Exception, match="boom"):
            change.write("b", numbers(spark, 4).withColumn("value", F.raise_error(F.lit("boom")).cast("int")))
    else:
        change.write("b", numbers(spark, 4, 2))
        monkeypatch.setattr(warehouse.marks, "put", lambda *a: (_ for _ in ()).throw(OSError("boom")))
        with pytest.raises(OSError):
            change.commit()
    assert {n: store.read(n).agg(F.count("*"), F.sum("value")).first()[:] for n in ("a", "b")} == {"a": (8, 8), "b": (8, 8)}


def test_of_two_runs_at_once_one_commits(spark, store):
    one, two = store.change(), store.change()
    one.write("a", numbers(spark, 1))
    two.write("a", numbers(spark, 2))
    assert one.commit() == 1
    with pytest.raises(FileExistsError):
        two.commit()
    assert store.read("a").count() == 1


def test_parts_are_replaced_and_pruned(spark, store):
    change = store.change()
    change.write("t", numbers(spark, 400, 1), by="day", within=["id"])
    change.commit()
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2)]
    assert sums(store.read("t")) == {d: (100, 100) for d in days}
    change = store.change()
    fresh = numbers(spark, 40, 5).where(F.col("day") == F.lit(days[1]))
    change.write("t", fresh, by="day", within=["id"], only=[str(days[1]), str(days[3])])
    change.commit()
    got = store.read("t")
    assert sums(got) == {days[0]: (100, 100), days[1]: (10, 50), days[2]: (100, 100)}
    assert sums(store.read("t", 1)) == {d: (100, 100) for d in days}
    assert got.columns == ["id", "value", "day"]
    plan = got.where(F.col("day") == F.lit(days[2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(ValueError, match="2024-01-30"):
        change.write("t", numbers(spark, 4), by="day", only=[str(days[1])])


def test_empty_tables(spark, store):
    change = store.change()
    change.write("whole", numbers(spark, 0))
    assert change.write("parts", numbers(spark, 0), by="day", within=["id"]).count() == 0
    change.commit()
    assert store.read("whole").schema.names == store.read("parts").schema.names == ["id", "value", "day"]
    assert store.read("parts").count() == 0
    with pytest.raises(LookupError):
        store.read("other")


def test_vacuum_keeps_what_new_versions_name(spark, store, tmp_path):
    for k in range(4):
        change = store.change()
        change.write("a", numbers(spark, k + 1))
        if k == 0:
            change.write("t", numbers(spark, 40, 1), by="day")
        else:
            change.write("t", numbers(spark, 40, k).where("day = date'2024-01-31'"), by="day", only=["2024-01-31"])
        change.commit()
    left = store.change()
    left.write("a", numbers(spark, 9))  # never committed
    store.vacuum(keep=2)
    assert store.versions() == [3, 4]
    assert store.read("a").count() == 4 and store.read("a", 3).count() == 3
    assert store.read("t").count() == store.read("t", 3).count() == 40
    assert len(list((tmp_path / "house/tables/a").iterdir())) == 2
    with pytest.raises(LookupError):
        store.read("a", 1)
