from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from basketry.llm import embedding_dedup as e

SCHEMA = "vec_id long, embedding array<float>, label int, node string, shard string, links string, n string, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *"vwxyz") for i, v, label in rows], SCHEMA).repartition(4)


def usable(v, label, size):
    return label is not None and v is not None and len(v) == size and None not in v and np.isfinite(v).all() and any(v)


def brute(rows, size, cosine=0.98):
    """(vec_id, n_links, component_id, kept) of every row, sorted."""
    able = [k for k, (i, v, label) in enumerate(rows) if i is not None and usable(v, label, size)]
    vectors = np.array([rows[k][1] for k in able], dtype=np.float64).reshape(len(able), -1)
    vectors /= np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    labels = np.array([rows[k][2] for k in able])
    linked = (vectors @ vectors.T >= cosine) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    parent = np.arange(len(able))
    e.unite(parent, *np.nonzero(linked))
    root = e.roots(parent, np.arange(len(able)))
    least = {}
    for k, r in zip(able, root, strict=True):
        least[r] = min(rows[k][0], least.get(r, rows[k][0]))
    out = {k: (rows[k][0], int(linked[j].sum()), least[root[j]], rows[k][0] == least[root[j]]) for j, k in enumerate(able)}
    return sorted((out.get(k, (i, 0, i, True)) for k, (i, _, _) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def made(rng, n, groups, size=24, labels=3):
    """(vec_id, vector, label): unrelated vectors, and groups of copies around the limit."""
    rows = []
    for k in range(n):
        rows.append((len(rows), rng.normal(size=size), int(k % labels)))
    for k in range(groups):
        for _ in range(int(rng.integers(1, 30))):
            copy = rows[k][1] + rng.normal(size=size) * rng.uniform(0.01, 0.25)
            rows.append((len(rows), copy * rng.uniform(0.1, 9), rows[k][2] if rng.random() < 0.8 else 0))
    return [(i, np.float32(v).tolist(), label) for i, v, label in rows]


def test_equals_brute_force_on_the_table(spark, sf, work):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = e.op12_embedding_dedup(table, work)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert found(got) == brute(rows, 64)


@pytest.mark.parametrize(("shard", "limit"), [(e.SHARD, e.LIMIT), (100, 4000), (200, 150)])
def test_equals_brute_force_over_many_shards_and_blocks(spark, work, monkeypatch, shard, limit):
    monkeypatch.setattr(e, "SHARD", shard)
    rows = made(np.random.default_rng(5), 900, 60)
    got = found(e.near_duplicates(frame(spark, rows), work, limit=limit))
    want = brute(rows, 24)
    assert sum(w[1] for w in want) > 1000
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, want, strict=True))
    if limit == e.LIMIT:
        assert got == want


def test_equal_vectors_nulls_and_odd_rows(spark, work):
    rows = [(i, [1.0, 2.0, 0.5], 1) for i in range(400)] + [(400 + i, [2.0, 4.0, 1.0], 1) for i in range(3)]
    rows += [(500, [1.0, 2.0, 0.5], 2), (501, [1.0, 2.0, 0.5], None), (502, None, 1), (503, [0.0, 0.0, 0.0], 1)]
    rows += [(504, [1.0, None, 0.5], 1), (505, [1.0, float("nan"), 0.5], 1), (506, [float("inf"), 2.0, 0.5], 1)]
    rows += [(507, [1.0, 2.0], 1), (508, [], 1), (None, [1.0, 2.0, 0.5], 1), (7, [1.0, 2.0, 0.5], 1), (-3, [1.0, 2.0, 0.5], 1)]
    got = found(e.near_duplicates(frame(spark, rows), work))
    assert got == brute(rows, 3)
    assert (0, 404, -3, False) in got and (7, 404, -3, False) in got


def test_very_large_and_very_small_numbers(spark, work):
    rows = [(1, [1e200, 2e200], 1), (2, [1e-200, 2e-200], 1), (3, [-1e-200, 2e-200], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(e.near_duplicates(table, work)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


@pytest.mark.parametrize("rows", [[], [(3, None, 1)], [(3, [1.0, 0.0], 1)]])
def test_few_rows(spark, work, rows):
    assert found(e.near_duplicates(frame(spark, rows), work)) == [(i, 0, i, True) for i, _, _ in rows]


def test_audit_sees_missing_links_and_shards_overlap_more(spark, work, monkeypatch):
    """With four clusters of one label and no overlap that helps, the audit asks for another round."""
    monkeypatch.setattr(e, "SHARD", 60)
    asked = []
    real = e._audit
    monkeypatch.setattr(e, "_audit", lambda *a: (asked.append(real(*a)), 0.5 if len(asked) < 2 else asked[-1])[1])
    rows = made(np.random.default_rng(6), 200, 20, labels=1)
    got = found(e.near_duplicates(frame(spark, rows), work))
    assert len(asked) == 2 and asked[1] >= asked[0] > 0.9
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in brute(rows, 24))
    none = spark.createDataFrame([], "node long, links long")
    classes = work.keep(spark.createDataFrame([(k, "1", 1, [1.0, 0.0]) for k in range(4)], "node long, label string, n long, vector array<double>"))
    assert real(none, classes, 0.98) == 0


def test_graph_points_both_ways_and_lists_stay_short():
    rng = np.random.default_rng(7)
    vectors = e.unit(np.concatenate([rng.normal(size=(700, 16)), rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.02]))
    lists = e.build_graph(vectors)
    assert max(map(len, lists)) <= e.MOST and all(k not in own for k, own in enumerate(lists))
    pairs = {(k, j) for k, own in enumerate(lists) for j in own}
    assert sum((j, k) in pairs for k, j in pairs) > 0.8 * len(pairs)
    hits = e.range_search(vectors, e.padded(lists), e.medoids(vectors), np.arange(1000), e.Rule(0.98, 2, e.BEAM))
    true = vectors @ vectors.T >= 0.98
    assert (hits & true).sum() >= 0.95 * true.sum() and not (hits & ~true).any()


class Counted:
    """A graph that counts the nodes whose neighbours were asked for."""

    left = 0

    def __init__(self, graph):
        self.graph = graph

    def __getitem__(self, nodes):
        Counted.left += len(nodes)
        return self.graph[nodes]


def local(vectors, clusters, overlap=2):
    """The steps of one label's search without Spark: (rows placed, links of each vector)."""
    n = len(vectors)
    batch = pa.RecordBatch.from_pydict({
        "node": np.arange(n), "label": ["1"] * n, "level": np.zeros(n, np.int64), "n": np.ones(n, np.int64), "vector": vectors.tolist()
    })
    placed = pa.Table.from_batches(e._place({0: e.centres(vectors, clusters)}, overlap)(iter([batch])))
    for name in ("block", "part", "against"):
        placed = placed.append_column(name, pa.array(np.zeros(len(placed), np.int32)))
    tasks = [placed.filter(pc.equal(placed["shard"], k)) for k in sorted(set(placed["shard"].to_pylist()))]
    lists = {}
    for task in tasks:
        for row in e._build(task).to_pylist():
            lists.setdefault(row["node"], set()).update(row["neighbours"])
    links = np.zeros(n, np.int64)
    for task in tasks:
        graph = pa.array([sorted(lists[k]) for k in task["node"].to_pylist()], pa.list_(pa.int64()))
        got = e._search(e.Rule(0.98, overlap, e.BEAM))(task.append_column("neighbours", graph))
        np.add.at(links, got["node"].to_numpy(), got["links"].to_numpy())
    return len(placed), links


def doubled(n, size=32):
    """Unrelated unit vectors, and a near copy of each tenth."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(n, size))
    return e.unit(np.concatenate([vectors, vectors[::10] + rng.normal(size=(len(vectors[::10]), size)) * 0.1]))


def test_work_for_a_vector_does_not_grow_with_the_table(monkeypatch):
    """Five times the vectors in five times the clusters: a walk is not repeated in a vector's other shards."""
    real, work = e.padded, []
    monkeypatch.setattr(e, "padded", lambda lists: Counted(real(lists)))
    for n, clusters in ((300, 1), (1500, 5)):
        vectors, Counted.left = doubled(n), 0
        links = local(vectors, clusters)[1]
        true = (vectors @ vectors.T >= 0.98).sum(axis=1) - 1
        assert (links == true).all() and true.sum() > n // 10
        work.append(Counted.left / len(vectors))
    assert work[1] < 1.4 * work[0]


def test_shards_that_would_all_hold_every_vector_are_one():
    vectors = doubled(300)
    assert local(vectors, 2)[0] == len(vectors)
    assert (local(vectors, 2)[1] == local(vectors, 1)[1]).all()


def test_a_search_from_the_vector_itself_finds_large_groups():
    """Without a walk: groups of hundreds, some pairs in reach and others not."""
    rng = np.random.default_rng(9)
    vectors = np.concatenate([rng.normal(size=(500, 24)), *(rng.normal(size=24) + rng.normal(size=(400, 24)) * s for s in (0.02, 0.1, 0.14))])
    vectors = e.unit(vectors)
    graph, at = e.padded(e.build_graph(vectors)), np.arange(len(vectors))
    hits = e.range_search(vectors, graph, e.medoids(vectors), at, e.Rule(0.98, 2, e.BEAM), np.zeros(len(at), dtype=bool))
    true = vectors @ vectors.T >= 0.98
    assert true.sum() > 200_000 and (hits & true).sum() >= 0.99 * true.sum() and not (hits & ~true).any()


def test_nearest_centres_are_those_of_a_stable_sort():
    rng = np.random.default_rng(10)
    found = e.unit(rng.normal(size=(40, 8)))[rng.integers(0, 40, 60)]
    vectors = e.unit(rng.normal(size=(3000, 8)))
    # Equal centres may differ in the last bit within a product of matrices.
    assert (found[e.nearest_centres(vectors, found, 3)] == found[np.argsort(-np.round(vectors @ found.T, 12), axis=1, kind="stable")[:, :3]]).all()
    assert e.nearest_centres(vectors[:0], found, 3).shape == (0, 3) and e.nearest_centres(vectors, found[:1], 3).shape == (3000, 1)
