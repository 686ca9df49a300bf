from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from basketry.llm import simhash as s
from basketry.llm.common import retain
from basketry.llm.ngrams import segments

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def brute_print(text, words=3):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [b" ".join(found)]
    ones = Counter()
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        ones.update(k for k in range(64) if h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


def brute_components(prints, reach=3):
    parent = np.arange(len(prints))
    for k in range(0, len(prints), 200):
        a, b = np.nonzero(np.bitwise_count(prints[k : k + 200, None] ^ prints[None, :]) <= reach)
        s.unite(parent, a + k, b)
    return s.roots(parent, np.arange(len(prints)))


def check(got, rows):
    prints = {t: brute_print(t) for _, t in rows if t is None or len(t) < 100_000}
    for r in got:
        assert re.fullmatch("[0-9a-f]{16}", r.fingerprint)
    assert len(got) == len(rows)
    want = np.array([prints[t] if t in prints else s.fingerprint(t) & (1 << 64) - 1 for _, t in rows], dtype=np.uint64)
    root = brute_components(want)
    least = {}
    for (i, _), k in zip(rows, root, strict=True):
        least[k] = min((x for x in (i, least.get(k)) if x is not None), default=None)
    expected = Counter((i, f"{int(f):016x}", least[k]) for (i, _), f, k in zip(rows, want, root, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected


def test_equals_brute_force(docs, pairs, work):
    check(s.op8_simhash(docs, work).collect(), pairs)


def test_odd_rows(odd_docs, odd_rows, work):
    check(s.op8_simhash(odd_docs, work).collect(), odd_rows)


def test_no_rows(no_docs, work):
    assert s.op8_simhash(no_docs, work).count() == 0


def near(rng, n, groups):
    base = rng.integers(0, 1 << 63, n).astype(np.uint64)
    copies = base[:groups].repeat(5)
    for _ in range(2):
        copies = copies ^ (np.uint64(1) << rng.integers(0, 64, len(copies)).astype(np.uint64))
    dense = np.full(1500, base[0])
    for _ in range(6):
        dense = dense ^ (np.uint64(1) << rng.integers(0, 64, len(dense)).astype(np.uint64))
    return np.unique(np.concatenate([base, copies, dense, np.zeros(1, np.uint64)]))


def test_tree_loses_no_link():
    prints = near(np.random.default_rng(1), 6000, 300)
    want = brute_components(prints)
    assert (s.components(prints) == want).all()
    tree = s.build(prints[::3], len(prints), leaf=600)
    leaf, at = s.place(prints, tree)
    parent = np.arange(len(prints))
    for k in range(leaf.max() + 1):
        own = np.sort(at[leaf == k])
        s.unite(parent, own, own[s.components(prints[own])])
    assert leaf.max() > 5 and (s.roots(parent, np.arange(len(prints))) == want).all()


@pytest.mark.parametrize("limit", [s.MAX_LEAF, 200])
def test_links_over_many_leaves(spark, work, monkeypatch, limit):
    """Also when large leaves are split again from samples of their own."""
    monkeypatch.setattr(s.build, "__defaults__", (s.MAX_DISTANCE, 300))
    monkeypatch.setattr(s, "LEAF_SAMPLE", 8)
    prints = near(np.random.default_rng(2), 2000, 100)
    classes = work.keep(spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "print long"))
    stars = {(r.a, r.b) for r in s.connect(s.links(classes, work, limit=limit), work).collect()}
    order = np.sort(prints.view(np.int64))
    root = brute_components(order.view(np.uint64))
    assert stars == {(int(order[k]), int(order[r])) for k, r in enumerate(root) if k != r}


@pytest.mark.parametrize("edges", [[(k + 1, k) for k in range(40)], [(k, 0) for k in range(1, 30)], [(5, 1), (5, 2), (9, 8)], []])
def test_components_of_chains_and_stars(spark, work, edges):
    frame = work.keep(spark.createDataFrame(edges, "a long, b long"))
    got = {r.a: r.b for r in s.connect(frame, work).collect()}
    nodes = {x for e in edges for x in e}
    parent = {x: x for x in nodes}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in nodes if find(x) != x}


def test_retain_keeps_the_smallest_id_of_each_group(odd_docs, odd_rows, work):
    decided = work.keep(s.near_duplicates(odd_docs, work).drop("component_id"))
    groups = {}
    for r in decided.collect():
        groups.setdefault(r.root, []).append(r.doc_id)
    left = retain(odd_docs, work.keep(s.verdicts(decided, work)), decided.count())
    assert left.columns == odd_docs.columns
    want = sorted(str(min((i for i in ids if i is not None), default=None)) for ids in groups.values())
    assert sorted(str(r.doc_id) for r in left.collect()) == want


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = "  ".join(f"Word{k % 97}" for k in range(3000))
    whole = s.fingerprint(text)
    assert whole & (1 << 64) - 1 == brute_print(text)
    monkeypatch.setattr(s, "SHINGLES_AT_ONCE", 50)
    monkeypatch.setattr(s, "segments", lambda t: segments(t, 90))
    assert s.fingerprint(text) == whole
