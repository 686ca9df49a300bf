"""Near-duplicates of embeddings: a flat graph built on overlapping shards, searched by range and audited.

Vectors of a label are dealt to their nearest clusters, several each. Every shard builds a graph whose
adjacency lists are pruned so that they point in different directions; a vector's lists of all its
shards are united into one flat graph. Then each vector searches its nearest shard, from its medoids and from
itself: greedily through what is nearest to it and, from what is within range, on through all that is. In
its other shards it begins at itself and goes through what is within range, so that an overlap does not
repeat the walk. Cosines in double precision decide. A sample is compared with all rows; if links are
missing, shards overlap more.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import SEED, attach
from basketry.llm.nearest import matrix, vector_type
from basketry.llm.simhash import connect, named_components, roots, unite
from basketry.scratch import Scratch

COSINE = 0.98
# A shard should hold so many vectors; one with more than LIMIT is dealt out in blocks, compared two by two.
SHARD, LIMIT = 2048, 8192
# Shards of a vector at first and at most, and what the audit asks for before it is content.
OVERLAP, MOST_OVERLAP, LEAST_RECALL = 2, 6, 0.97
AUDIT = 1024
# Cluster centres are fitted on so many vectors at most; the finest division has 2**LEVELS clusters.
SAMPLE, ROUNDS, LEVELS = 32_768, 6, 12
# Of a vector's nearest NEAR, and of as many drawn at random, so many neighbours are kept at most, and of all
# vectors that point to it so many that its list stays below MOST.
NEAR, CLOSE, FAR, MOST, SPREAD = 64, 16, 8, 64, 1.2
BEAM, MEDOIDS = 24, 8
AT_ONCE = 256
FRONTIER = 1 << 15
# Graphs are built and walked in single precision; a cosine this close to the limit is worked out in double.
DOUBT = 1e-4


@dataclass(frozen=True)
class Rule:
    cosine: float
    overlap: int
    beam: int

    @property
    def reach(self) -> float:
        """Search goes on from vectors up to half as far again as a link."""
        return 1 - 2.25 * (1 - self.cosine)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square is too large or too small."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def centres(sample: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Cluster centres of unit vectors (spherical k-means); a centre that lost all its vectors stays."""
    rng = np.random.default_rng(SEED)
    found = sample[np.sort(rng.choice(len(sample), min(k, len(sample)), replace=False))]
    for _ in range(rounds):
        own = nearest_centres(sample, found, 1)[:, 0]
        sums = np.zeros_like(found)
        np.add.at(sums, own, sample)
        size = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        found = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), found)
    return found


def nearest_centres(vectors: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """The numbers of each vector's k nearest centres, nearest first; of equally near ones the first."""
    out = np.zeros((len(vectors), min(k, len(found))), dtype=np.int64)
    for at in range(0, len(vectors), 1024):
        cosine = vectors[at : at + 1024] @ found.T
        for n in range(out.shape[1]):
            own = out[at : at + 1024, n] = cosine.argmax(axis=1)
            cosine[np.arange(len(own)), own] = -np.inf
    return out


def robust(chosen_from: np.ndarray, away: np.ndarray, between: np.ndarray, keep: int) -> np.ndarray:
    """Which of each row's candidates, nearest first, become neighbours: one that a nearer neighbour is closer to, by
    a factor of SPREAD, is left out. ``away`` has squared distances to the candidates, ``between`` among them."""
    alive = chosen_from.copy()
    kept = np.zeros_like(alive)
    rows = np.arange(len(alive))
    for _ in range(keep):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        kept[rows[some], first[some]] = True
        covered = SPREAD**2 * between[rows, first] <= away
        alive &= ~(covered & some[:, None])
        alive[rows, first] = False
    return kept


def build_graph(vectors: np.ndarray) -> list[np.ndarray]:
    """For each unit vector its neighbours' positions: pruned ones among its nearest and among some drawn at random."""
    m, rng = len(vectors), np.random.default_rng(SEED)
    vectors = vectors.astype(np.float32)
    if m < 2:
        return [np.zeros(0, dtype=np.int64)] * m
    own, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, m, AT_ONCE):
        rows = np.arange(at, min(at + AT_ONCE, m))
        cosine = vectors[rows] @ vectors.T
        cosine[rows - at, rows] = -np.inf
        near = min(NEAR, m - 1)
        drawn = np.sort(rng.choice(m, min(AT_ONCE, m), replace=False))
        far = np.argsort(-cosine[:, drawn], axis=1)[:, :near]
        for candidates, keep in (
            (np.argpartition(-cosine, max(near - 1, 0), axis=1)[:, :near], CLOSE),
            (drawn[far], FAR),
        ):
            score = np.take_along_axis(cosine, candidates, axis=1)
            order = np.argsort(-score, axis=1, kind="stable")
            candidates, score = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(score, order, axis=1)
            held = vectors[candidates]
            between = 2 - 2 * held @ held.transpose(0, 2, 1)
            kept = robust(np.isfinite(score), 2 - 2 * np.where(np.isfinite(score), score, -1), between, keep)
            i, j = np.nonzero(kept)
            own.append(rows[i])
            other.append(candidates[i, j])
    own, other = np.concatenate(own), np.concatenate(other)
    # Links go both ways; who is pointed to very often keeps some of these, drawn at random.
    forward = np.unique(own * m + other)
    back = np.setdiff1d(np.unique(other * m + own), forward, assume_unique=True)
    back = back[rng.permutation(len(back))]
    back = back[np.argsort(back // m, kind="stable")]
    place = np.arange(len(back)) - np.searchsorted(back // m, back // m)
    room = MOST - np.bincount(forward // m, minlength=m)
    both = np.sort(np.concatenate([forward, back[place < room[back // m]]]))
    return np.split(both % m, np.searchsorted(both // m, np.arange(1, m)))


def padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), -1, dtype=np.int64)
    for row, own in zip(out, lists, strict=True):
        row[: len(own)] = own
    return out


def medoids(vectors: np.ndarray) -> np.ndarray:
    """Positions of the vectors nearest to the centres of a few clusters: where searches begin."""
    found = centres(vectors[: SHARD * 2], MEDOIDS, rounds=3)
    return np.unique((vectors @ found.T).argmax(axis=0))


def range_search(
    vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, at: np.ndarray, rule: Rule, walks: np.ndarray | None = None
) -> np.ndarray:
    """For the vectors at ``at`` which of all were found within the cosine (a row of booleans each).

    Those that ``walks`` names (all without it) also walk greedily, from ``starts`` too.
    """
    q, m = len(at), len(vectors)
    light = vectors.astype(np.float32)
    seen, hits, open_ = (np.zeros((q, m), dtype=bool) for _ in range(3))

    def note(row: np.ndarray, node: np.ndarray) -> np.ndarray:
        cosine = np.concatenate([
            np.einsum("pd,pd->p", light[at[row[k : k + FRONTIER]]], light[node[k : k + FRONTIER]]) for k in range(0, len(row) or 1, FRONTIER)
        ])
        doubt = np.flatnonzero(np.abs(cosine - rule.cosine) < DOUBT)
        within = cosine >= rule.cosine
        within[doubt] = np.einsum("pd,pd->p", vectors[at[row[doubt]]], vectors[node[doubt]]) >= rule.cosine - 1e-9
        seen[row, node] = True
        hits[row, node] = within
        open_[row, node] = cosine >= rule.reach - DOUBT
        return cosine

    note(np.arange(q), at)
    # Greedily through what is nearest: always from the nearest node that was not yet left, while it is in the beam.
    rows = np.arange(q) if walks is None else np.flatnonzero(walks)
    first = np.concatenate([np.broadcast_to(starts, (len(rows), len(starts))), at[rows, None]], axis=1)
    near = note(np.repeat(rows, first.shape[1]), first.ravel()).reshape(first.shape)
    # A medoid is among its own starts twice; one of them counts as left.
    done = np.concatenate([starts[None, :] == at[rows, None], np.zeros((len(rows), 1), dtype=bool)], axis=1)
    near[done] = -np.inf
    node = first
    while len(rows):
        r = np.arange(len(rows))
        pick = np.where(done, -np.inf, near).argmax(axis=1)
        done[r, pick] = True
        left = node[r, pick]
        open_[rows, left] = False
        ahead = graph[left]
        fresh = (ahead >= 0) & ~seen[rows[:, None], ahead]
        cosine = np.full(ahead.shape, -np.inf, dtype=np.float32)
        cosine[fresh] = note(np.repeat(rows, fresh.sum(axis=1)), ahead[fresh])
        near, node, done = (np.concatenate(x, axis=1) for x in ((near, cosine), (node, ahead), (done, ~fresh)))
        best = np.argpartition(-near, min(rule.beam, near.shape[1]) - 1, axis=1)[:, : rule.beam]
        near, node, done = (np.take_along_axis(x, best, axis=1) for x in (near, node, done))
        active = ~done.all(axis=1)
        if not active.all():
            rows, near, node, done = rows[active], near[active], node[active], done[active]
    # From everything within reach to its neighbours, as long as new ones are.
    while open_.any():
        r, node = np.divmod(np.flatnonzero(open_)[:FRONTIER], m)
        open_[r, node] = False
        ahead = graph[node]
        fresh = (ahead >= 0) & ~seen[r[:, None], ahead]
        note(*np.divmod(np.unique((r[:, None] * m + ahead)[fresh]), m))
    return hits


def owners(shards: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least shard that both vectors of each pair are in: there their link counts."""
    both = shards[a][:, :, None] == shards[b][:, None, :]
    return np.where(both.any(axis=2), shards[a], np.iinfo(np.int64).max).min(axis=1)


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, vector (null if the row takes no part) and a 128-bit key of label and vector."""
    kind = vector_type(vectors, vector_col)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("vector")
    )
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("vector", F.when(able, F.col("vector")))
    keys = {f"k{k}": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(k), "label", "vector")) for k in (0, 1)}
    return rows.withColumns(keys)


def _levels(classes: DataFrame, work: Scratch) -> DataFrame:
    """How finely each label is divided: a vector of a label with n distinct ones has 2**level clusters to go to."""
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    fine = F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / F.lit(SHARD)))).cast("int")
    sizes = work.keep(sizes.withColumn("level", F.least(F.lit(LEVELS), fine)), "labels")
    return work.keep(attach(classes, sizes, ["label"], "size", classes.count()).drop("size"), "levelled")


def _place(centre_sets: dict[int, np.ndarray], overlap: int):
    """A row for each shard of each vector, with all its shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, vectors = batch.column("level").to_numpy(), unit(matrix(batch.column("vector")))
            for own in np.unique(level):
                rows = np.flatnonzero(level == own)
                found = centre_sets[int(own)]
                # With no more clusters than that, every vector would be in all of them: one shard will do.
                found = found if len(found) > overlap else found[:1]
                shards = nearest_centres(vectors[rows], found, overlap)
                part, width = batch.take(pa.array(rows)), shards.shape[1]
                for k in range(width):
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c) for c in ("node", "label", "n", "vector")),
                            pa.array(shards[:, k]),
                            pa.array(list(shards), pa.list_(pa.int64())),
                        ],
                        names=["node", "label", "n", "vector", "shard", "shards"],
                    )

    return work


TASK = ["label", "shard", "part", "against"]


def _dealt(placed: DataFrame, limit: int) -> DataFrame:
    """Each shard's rows as tasks: one, or one for every two blocks of a shard with more than ``limit`` rows."""
    large = placed.groupBy("label", "shard").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > limit)
    blocks = F.coalesce(F.ceil(F.col("held") * 2 / limit), F.lit(1)).cast("int")
    rows = placed.join(large, ["label", "shard"], "left").withColumn("blocks", blocks).drop("held")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other).drop("blocks")
    return rows.withColumns({"part": F.least("block", "other"), "against": F.greatest("block", "other")}).drop("other")


def _build(task: pa.Table) -> pa.Table:
    nodes = task.column("node").to_numpy()
    order = np.argsort(nodes)
    nodes, vectors = nodes[order], unit(matrix(task.column("vector")))[order]
    lists = build_graph(vectors)
    return pa.table({"node": nodes, "neighbours": pa.array([nodes[own] for own in lists], pa.list_(pa.int64()))})


def _search(rule: Rule):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def work(task: pa.Table) -> pa.Table:
        task = task.sort_by("node")
        nodes, n = task.column("node").to_numpy(), task.column("n").to_numpy()
        original, shards, block = matrix(task.column("vector")), matrix(task.column("shards")).astype(np.int64), task.column("block").to_numpy()
        vectors, here = unit(original), task.column("shard")[0].as_py()
        apart = task.column("part")[0].as_py() != task.column("against")[0].as_py()
        known = task.column("neighbours").combine_chunks()
        lengths, flat = known.value_lengths().to_numpy(zero_copy_only=False), known.flatten().to_numpy()
        place = np.minimum(np.searchsorted(nodes, flat), len(nodes) - 1)
        inside = nodes[place] == flat
        row = np.repeat(np.arange(len(nodes)), lengths)[inside]
        graph = padded(np.split(place[inside], np.searchsorted(row, np.arange(1, len(nodes)))))
        starts = medoids(vectors)
        found = np.zeros((len(nodes), len(nodes)), dtype=bool)
        for at in range(0, len(nodes), AT_ONCE):
            rows = np.arange(at, min(at + AT_ONCE, len(nodes)))
            found[rows] = range_search(vectors, graph, starts, rows, rule, shards[rows, 0] == here)
        links, parent = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
        for at in range(0, len(nodes), AT_ONCE):
            a, b = np.nonzero((found[at : at + AT_ONCE] | found[:, at : at + AT_ONCE].T))
            a += at
            a, b = a[a < b], b[a < b]
            close = np.einsum("pd,pd->p", vectors[a], vectors[b]) >= rule.cosine
            a, b = a[close], b[close]
            unite(parent, a, b)
            counted = owners(shards, a, b) == here
            if apart:
                counted &= block[a] != block[b]
            np.add.at(links, a[counted], n[b[counted]])
            np.add.at(links, b[counted], n[a[counted]])
        root = roots(parent, np.arange(len(nodes)))
        return pa.Table.from_arrays([pa.array(nodes), pa.array(links), pa.array(nodes[root])], schema=schema)

    return work


def _audit(found: DataFrame, classes: DataFrame, cosine: float) -> float:
    """Of the links that a sample of vectors has by brute force, the share that was found (1.0 without any)."""
    spark, total = classes.sparkSession, classes.count()
    drawn = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 31))
    share = min(1.0, 1.5 * AUDIT / max(total, 1)) * (1 << 31)
    sample = classes.where(drawn < share).orderBy(drawn).limit(AUDIT).select("node", "label", "vector").collect()
    if not sample:
        return 1.0
    number = {label: k for k, label in enumerate(dict.fromkeys(r.label for r in sample))}
    asked = unit(np.array([r.vector for r in sample], dtype=np.float64))
    shared = spark.sparkContext.broadcast((np.array([r.node for r in sample]), np.array([number[r.label] for r in sample]), asked))

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, labels, vectors = shared.value
        links = np.zeros(len(nodes), dtype=np.int64)
        for batch in batches:
            own = unit(matrix(batch.column("vector")))
            near = vectors @ own.T >= cosine
            near &= labels[:, None] == np.array([number.get(x, -1) for x in batch.column("label").to_pylist()])[None, :]
            near &= nodes[:, None] != batch.column("node").to_numpy()[None, :]
            links += near @ batch.column("n").to_numpy()
        yield pa.RecordBatch.from_pydict({"node": nodes, "true": links})

    true = classes.select("node", "label", "n", "vector").mapInArrow(truth, "node long, true long")
    true = true.groupBy("node").agg(F.sum("true").alias("true"))
    sums = true.join(found, "node", "left").agg(F.sum("true"), F.sum(F.coalesce("links", F.lit(0)))).first()
    return sums[1] / sums[0] if sums[0] else 1.0


def near_duplicates(
    vectors: DataFrame,
    work: Scratch,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    limit: int = LIMIT,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows are linked if their labels are equal and their vectors' cosine, in double precision, is
    ``cosine`` or more. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable, ``kept`` whether that is the row's own. Rows with a null id, label or vector,
    a zero vector, one with a null or non-finite component or of another length than most link with
    nothing and are kept. Equal vectors of a label are one entry of the graph, however many there are;
    repeated ids are rows of their own. An empty table gives an empty result.

    No link below the cosine is given. Some above may be missed: a sample is compared with all rows, and
    while less than LEAST_RECALL of its links were found everything is searched again with vectors in one
    more shard; a warning says so if MOST_OVERLAP is not enough. A shard's task holds ``limit`` vectors
    at most and returns one row for each.
    """
    spark = vectors.sparkSession
    rows = work.keep(_usable(vectors, id_col, vector_col, label_col), "usable")
    sizes = rows.where("vector IS NOT NULL").groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    able = rows.where(F.size("vector") == (common.size if common else -2))
    classes = able.groupBy("k0", "k1").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    classes = _levels(work.keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes"), work)

    drawn = F.pmod(F.xxhash64(F.lit("centres"), "node"), F.lit(1 << 31))
    share = min(1.0, 1.5 * SAMPLE / max(classes.count(), 1)) * (1 << 31)
    sample = np.array([r.vector for r in classes.where(drawn < share).orderBy(drawn).limit(SAMPLE).select("vector").collect()], dtype=np.float64)
    levels = [r.level for r in classes.select("level").distinct().collect()]
    fitted = spark.sparkContext.broadcast({k: centres(unit(sample), 1 << k) if k else np.zeros((1, sample.shape[1])) for k in levels})

    found = edges = None
    for overlap in range(OVERLAP, MOST_OVERLAP + 1):
        rule = Rule(cosine, overlap, BEAM * overlap // OVERLAP)
        placed = classes.select("node", "label", "level", "n", "vector").mapInArrow(
            _place(fitted.value, overlap),
            f"node long, label string, n long, vector {vector_type(classes, 'vector')}, shard long, shards array<long>",
        )
        placed = work.keep(_dealt(work.keep(placed, "placed"), limit), "dealt")
        lists = placed.select("node", "vector", *TASK).groupBy(*TASK).applyInArrow(_build, "node long, neighbours array<long>")
        graph = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
        graph = work.keep(graph, "graph")
        searched = placed.join(graph, "node").groupBy(*TASK).applyInArrow(_search(rule), "node long, links long, root long")
        searched = work.keep(searched.where("links > 0 OR node <> root"), "searched")
        found = work.keep(searched.groupBy("node").agg(F.sum("links").alias("links")), "found")
        edges = searched.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
        recall = _audit(found, classes, cosine)
        if recall >= LEAST_RECALL:
            break
    else:
        warnings.warn(f"a sample's links were found to {recall:.1%}", stacklevel=2)

    named = named_components(connect(work.keep(edges, "edges"), work), classes, "node", work)
    groups = (
        classes.drop("vector", "level", "label")
        .join(found, "node", "left")
        .join(named.select("node", "component_id"), "node", "left")
        .select(
            "k0",
            "k1",
            "n",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id"),
        )
    )
    linked = attach(able.select("vec_id", "k0", "k1"), work.keep(groups, "groups"), ["k0", "k1"], "n", able.count())
    alone = rows.where(F.coalesce(F.size("vector"), F.lit(-1)) != (common.size if common else -2))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_embedding_dedup(vectors: DataFrame, work: Scratch) -> DataFrame:
    return near_duplicates(vectors, work)
