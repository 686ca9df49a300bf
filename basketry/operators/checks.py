"""Data checks: each one is a row with the number of failures it found."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.bitsets import BITS, WORD, has, small_set, word_of
from basketry.schemas import TABLES, Table
from basketry.sources.load import union_all

Tables = Mapping[str, DataFrame]
KINDS = ("unique", "not_null", "relationships")


@dataclass(frozen=True)
class Check:
    """``kind`` is unique, not_null or relationships; the last has a parent table and column."""

    kind: str
    table: str
    column: str
    parent: tuple[str, str] | None = None
    severity: str = "warn"


# The column tests that come with the staging tables.
STAGING_CHECKS = (
    Check("unique", "users", "id"),
    Check("not_null", "users", "id"),
    Check("unique", "users", "email"),
    Check("not_null", "users", "email"),
    Check("unique", "products", "id"),
    Check("not_null", "products", "id"),
    Check("unique", "orders", "id"),
    Check("not_null", "orders", "id"),
    Check("not_null", "orders", "user_id"),
    Check("relationships", "orders", "user_id", ("users", "id")),
    Check("unique", "order_items", "id"),
    Check("not_null", "order_items", "id"),
    Check("relationships", "order_items", "order_id", ("orders", "id")),
)


def constraint_checks(tables: Iterable[Table] = tuple(TABLES.values())) -> list[Check]:
    """Every key, required column and reference of the source schema as a check."""
    checks = []
    for t in tables:
        checks += [Check("unique", t.name, c) for c in t.unique]
        checks += [Check("not_null", t.name, c) for c in t.required]
        checks += [Check("relationships", t.name, c, p) for c, p in t.references.items()]
    return checks


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(value, rows): references that lead nowhere.

    Known values are a set of bits that every task has, if their range is bounded: then only orphans move.
    Else both sides are reduced to one row per value before they are joined, so a value with very many
    rows reaches the join once.
    """
    value = F.col(column).alias("value")
    known = small_set(parent, parent_column)
    used = child.where(F.col(column).isNotNull())
    if known is not None:
        used = _lost(used, {"_lost": (column, known)}).where("_lost")
    counted = used.groupBy(value).agg(F.count(F.lit(1)).alias("rows"))
    if known is not None:
        return counted
    return counted.join(parent.select(F.col(parent_column).alias("value")).distinct(), "value", "left_anti")


def _lost(df: DataFrame, references: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Add a flag for each reference: whether its value is not null and not in the set. No row moves."""
    out = df
    for flag, (column, known) in references.items():
        words = known.select(F.col(WORD).alias(f"{flag}_word"), F.col(BITS).alias(f"{flag}_bits"))
        member = F.col(column)
        out = out.join(F.broadcast(words), word_of(member) == F.col(f"{flag}_word"), "left")
        out = out.withColumn(flag, member.isNotNull() & ~has(F.col(f"{flag}_bits"), member)).drop(f"{flag}_word", f"{flag}_bits")
    return out


def _value(df: DataFrame, column: str) -> list[Column]:
    """A value as a number or else as text."""
    c, whole = F.col(column), isinstance(df.schema[column].dataType, T.IntegralType)
    return [
        (c if whole else F.lit(None)).cast("long").alias("number"),
        (F.lit(None) if whole else c).cast("string").alias("text"),
    ]


def table_failures(tables: Tables, table: str, checks: Sequence[Check]) -> DataFrame:
    """(number of the check, failures) of all checks of a table, from one scan of it and one shuffle.

    Each row is turned into what the checks want of it: values that must be unique, nulls that must not
    be, references that lead nowhere. These are counted by value, and the counts by check.
    """
    df, wanted, sets, references = tables[table], [], {}, {}
    none = [F.lit(None).cast("long").alias("number"), F.lit(None).cast("string").alias("text")]
    joined = {}
    for k, c in enumerate(checks):
        if c.kind == "relationships":
            if c.parent not in sets:
                sets[c.parent] = small_set(tables[c.parent[0]], c.parent[1])
            if sets[c.parent] is None or not isinstance(df.schema[c.column].dataType, T.IntegralType):
                lost = orphans(df, c.column, tables[c.parent[0]], c.parent[1])
                joined[k] = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
                continue
            references[f"_lost{k}"] = (c.column, sets[c.parent])
            kept = F.col(f"_lost{k}")
        elif c.kind == "unique":
            kept = F.col(c.column).isNotNull()
        else:
            kept = F.col(c.column).isNull()
        value = _value(df, c.column) if c.kind == "unique" else none
        wanted.append((k, F.when(kept, F.struct(F.lit(k).alias("check"), *value))))
    parts = [found.select(F.lit(k).alias("check"), "failures") for k, found in joined.items()]
    if wanted:
        columns = list(dict.fromkeys(c.column for c in checks))
        marked = _lost(df.select(*columns), references)
        each = marked.select(F.explode(F.filter(F.array(*[w for _, w in wanted]), lambda x: x.isNotNull())).alias("at"))
        counted = each.groupBy("at.check", "at.number", "at.text").agg(F.count(F.lit(1)).alias("n"))

        def failures(k: int) -> Column:
            n = (F.col("n") > 1).cast("long") if checks[k].kind == "unique" else F.col("n")
            return F.coalesce(F.sum(F.when(F.col("check") == k, n)), F.lit(0)).alias(f"c{k}")

        sums = counted.agg(*[failures(k) for k, _ in wanted])
        pairs = [F.struct(F.lit(k).alias("check"), F.col(f"c{k}").alias("failures")) for k, _ in wanted]
        parts.append(sums.select(F.explode(F.array(*pairs)).alias("r")).select("r.*"))
    return union_all(parts)


def report(tables: Tables, checks: Sequence[Check] = STAGING_CHECKS) -> DataFrame:
    """One row per check: test, table_name, column_name, failures, severity, status."""
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind not in KINDS:
            raise ValueError(f"unknown check {c.kind!r}")
        by_table.setdefault(c.table, []).append(c)
    parts = []
    for table, own in by_table.items():
        found = table_failures(tables, table, own)
        about = [
            F.get(F.array(*[F.lit(x) for x in column]), F.col("check")).alias(name)
            for name, column in (
                ("test", [c.kind for c in own]),
                ("column_name", [c.column for c in own]),
                ("severity", [c.severity for c in own]),
            )
        ]
        parts.append(found.select(F.lit(table).alias("table_name"), F.col("failures").cast("long").alias("failures"), *about))
    status = F.when(F.col("failures") > 0, F.col("severity")).otherwise("pass").alias("status")
    return union_all(parts).select("test", "table_name", "column_name", "failures", "severity", status)


class ChecksFailed(Exception):
    """Raised when checks of a severity that stops the run found failures."""


def enforce(result: DataFrame, fail_on: str | None = None) -> DataFrame:
    """Return the report, or raise if a check of severity ``fail_on`` failed.

    By default failures are reported and the run goes on. The report has one row per check.
    """
    if fail_on is not None:
        failed = result.where((F.col("severity") == fail_on) & (F.col("failures") > 0)).collect()
        if failed:
            raise ChecksFailed("; ".join(f"{r.test} {r.table_name}.{r.column_name}: {r.failures}" for r in failed))
    return result
