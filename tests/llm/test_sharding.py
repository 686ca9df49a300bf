from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from basketry.llm import sharding as s


def check(rows, texts_by_row, shards=16):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts_by_row
    )
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_every_row_has_a_place_and_bytes_are_near_equal(docs, pairs, work):
    rows = s.op1_sharding(docs, work).collect()
    check(rows, pairs)
    filled = Counter()
    for r in rows:
        filled[r.shard] += r.size
    biggest = max(len((t or "").encode()) + 1 for _, t in pairs)
    assert max(filled.values()) - min(filled[k] for k in range(16)) <= biggest
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_equal_texts_share_a_shard(docs, pairs, work):
    text = dict(pairs)
    where = defaultdict(set)
    for r in s.op1_sharding(docs, work).collect():
        where[text[r.doc_id]].add(r.shard)
    assert all(len(v) == 1 for v in where.values())


def test_odd_rows(odd_docs, odd_rows, work):
    check(s.op1_sharding(odd_docs, work).collect(), odd_rows)


def test_no_rows(no_docs, work):
    assert s.op1_sharding(no_docs, work).count() == 0


def test_a_slot_heavier_than_a_shard_is_dealt_out(spark, work):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text " * 5).otherwise(F.concat(F.lit("t" * 60), "id")).alias("text")
    )
    rows = s.shard(docs, work, shards=8).collect()
    filled = Counter()
    for r in rows:
        filled[r.shard] += r.size
    assert max(filled.values()) < 1.1 * sum(filled.values()) / 8
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_growing_moves_slots_into_the_new_shard_only(spark, work):
    units = [s.Unit(k, s.WHOLE, 100 + k % 37) for k in range(s.SLOTS)]
    first = s.assign(units, 16)
    grown = s.grow(first, 16)
    filled = Counter()
    for (unit, before), (same, after) in zip(first, grown, strict=True):
        assert unit == same and after in (before, 16)
        filled[after] += unit.bytes
    fair = sum(filled.values()) / 17
    assert all(abs(b - fair) < 0.03 * fair for b in filled.values())
    path = work.path("map")
    s.save_map(spark, path, first, 1)
    s.save_map(spark, path, grown, 2)
    assert dict(s.load_map(spark, path, 1)) == dict(first)
    assert dict(s.load_map(spark, path, 2)) == dict(grown)


def test_shards_equal_a_plain_greedy_map(spark, work):
    """Every row's shard, from the hash of its text and slots placed one by one."""
    rows = [(k, f"{'é' * (k % 23)}text {k // 3}") for k in range(3000)]
    loads = Counter()
    home = {}
    for i, x in rows:
        home[i] = xxhash.xxh64(x.encode(), seed=42).intdigest() % s.SLOTS
        loads[home[i]] += len(x.encode()) + 1
    filled, shard_of = [0] * 16, {}
    for slot in sorted(loads, key=lambda k: (-loads[k], k)):
        shard_of[slot] = filled.index(min(filled))
        filled[shard_of[slot]] += loads[slot]
    got = s.op1_sharding(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), work).collect()
    assert {r.doc_id: (r.virtual_slot, r.shard) for r in got} == {i: (home[i], shard_of[home[i]]) for i, _ in rows}
    assert len(got) == len(rows)
