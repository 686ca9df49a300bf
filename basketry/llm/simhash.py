"""SimHash near-duplicates: fingerprints, a vantage-point tree over them, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import SEED, append_columns, attach, texts
from basketry.llm.ngrams import segments
from basketry.scratch import Scratch

WORDS = 3
MAX_DISTANCE = 3
BITS = 64

# The tree's upper part is fitted on so many fingerprints at most; every fingerprint is then placed in it.
SAMPLE = 32_768
# A leaf of the upper part should hold so many fingerprints, and is split while it holds enough of the sample.
LEAF = 8192
LEAF_SAMPLE = 32
# A leaf that turns out to hold more is split again, from a sample of its own.
MAX_LEAF = 65_536
SPLIT_SAMPLE, SPLIT_AT_ONCE, SPLITS = 256, 4096, 12
VANTAGE_TRIES = 8
# Inside a leaf, blocks of so many fingerprints are compared directly.
BLOCK = 512
SHINGLES_AT_ONCE = 1 << 18
ROUNDS = 60


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, each place of a shingle once, in arrays of bounded length.

    A-Z count as a-z, words end at ASCII white space, a shingle is ``words`` words in a row. With fewer
    words their whole sequence is the shingle; without any there is none.
    """
    held: list[bytes] = []
    short = True
    for part in segments(text or ""):
        held += part.encode().lower().split()
        while len(held) >= words:
            own = held[: SHINGLES_AT_ONCE + words - 1]
            shingles = own if words == 1 else map(b" ".join, zip(*(own[i:] for i in range(words)), strict=False))
            yield np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
            held = held[len(own) - words + 1 :]
            short = False
    if short and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], dtype="<u8")


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit integer: a bit is 1 if it is set in over half the shingles' hashes; 0 without words."""
    total, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, words):
        total += ones(hashes)
        n += len(hashes)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text as given) and print of every row."""

    def columns(batch: list[str | None]) -> dict[str, list[int]]:
        return {"print": [fingerprint(t, words) for t in batch]}

    rows = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return append_columns(rows, columns, "print long", drop_text=True)


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass(frozen=True)
class Node:
    """Fingerprints up to ``radius`` from the vantage point are inside, others outside.

    Those less than the largest distance beyond the border also visit the inside: by the triangle
    inequality no one further out can have a partner there.
    """

    vantage: np.uint64
    radius: int
    inside: Node | int
    outside: Node | int


def build(sample: np.ndarray, total: int, reach: int = MAX_DISTANCE, leaf: int = LEAF) -> Node | int:
    """The upper tree over ``total`` fingerprints from a sample of them; leaves are numbered from 0."""
    rng = np.random.default_rng(SEED)
    scale = max(total, 1) / max(len(sample), 1)
    leaves = iter(range(1 << 62))

    def split(members: np.ndarray) -> Node | int:
        if len(members) * scale <= leaf or len(members) < LEAF_SAMPLE:
            return next(leaves)
        best = None
        for vantage in rng.choice(members, VANTAGE_TRIES):
            upto = np.cumsum(np.bincount(distance(members, vantage), minlength=BITS + 1))
            visits = upto[np.minimum(np.arange(BITS + 1) + reach, BITS)]
            cost = visits**2 + (len(members) - upto) ** 2
            radius = int(cost.argmin())
            if best is None or cost[radius] < best[0]:
                best = (int(cost[radius]), vantage, radius)
        cost, vantage, radius = best
        if cost > 0.95 * len(members) ** 2:
            return next(leaves)  # no border parts them
        d = distance(members, vantage)
        return Node(vantage, radius, split(members[d <= radius + reach]), split(members[d > radius]))

    return split(sample)


def place(prints: np.ndarray, tree: Node | int, reach: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, position in ``prints``): every leaf in which a fingerprint lives or must look for partners."""
    leaves, positions = [], []

    def go(at: np.ndarray, node: Node | int) -> None:
        if not len(at):
            return
        if not isinstance(node, Node):
            leaves.append(np.full(len(at), node, dtype=np.int64))
            positions.append(at)
            return
        d = distance(prints[at], node.vantage)
        go(at[d <= node.radius + reach], node.inside)
        go(at[d > node.radius], node.outside)

    go(np.arange(len(prints)), tree)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *leaves]), np.concatenate([none, *positions])


def leaves_of(node: Node | int) -> int:
    return leaves_of(node.inside) + leaves_of(node.outside) if isinstance(node, Node) else 1


def roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    up = parent[at]
    while (up != (upper := parent[up])).any():
        parent[at] = upper
        up = upper
    return up


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs (a, b); the smallest position is the root."""
    while len(a):
        a, b = roots(parent, a), roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def components(prints: np.ndarray, reach: int = MAX_DISTANCE) -> np.ndarray:
    """For each fingerprint the position of the first one in the same component, by a tree over them.

    Pairs on either side of a vantage point's border are compared only if both lie near it.
    """
    parent = np.arange(len(prints))
    rng = np.random.default_rng(SEED)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), BLOCK):
            for bt in range(0, len(b), BLOCK):
                left, right = a[at : at + BLOCK], b[bt : bt + BLOCK]
                i, j = np.nonzero(distance(prints[left][:, None], prints[right][None, :]) <= reach)
                unite(parent, left[i], right[j])

    def border(a: np.ndarray) -> tuple[np.ndarray, int] | None:
        """Distances to a vantage point and a radius with enough of ``a`` on either side."""
        for vantage in rng.choice(a, VANTAGE_TRIES):
            d = distance(prints[a], prints[vantage]).astype(np.int64)
            radius = int(np.median(d))
            for radius in (radius, radius - 1):
                inside = int((d <= radius).sum())
                if min(inside, len(a) - inside) > 0.05 * len(a):
                    return d, radius
        return None

    def within(a: np.ndarray) -> None:
        found = border(a) if len(a) > BLOCK else None
        if found is None:
            compare(a, a)
            return
        d, radius = found
        within(a[d <= radius])
        within(a[d > radius])
        across(a[(d <= radius) & (d > radius - reach)], a[(d > radius) & (d <= radius + reach)], len(a))

    def across(a: np.ndarray, b: np.ndarray, before: int) -> None:
        if not len(a) or not len(b):
            return
        if len(a) + len(b) <= 2 * BLOCK or len(a) + len(b) > 0.95 * before:
            compare(a, b)
            return
        vantage = prints[rng.choice(a if len(a) > len(b) else b)]
        da, db = distance(prints[a], vantage).astype(np.int64), distance(prints[b], vantage).astype(np.int64)
        radius = int(np.median(np.concatenate([da, db])))
        size = len(a) + len(b)
        across(a[da <= radius], b[db <= radius], size)
        across(a[da > radius], b[db > radius], size)
        across(a[(da <= radius) & (da > radius - reach)], b[(db > radius) & (db <= radius + reach)], size)
        across(a[(da > radius) & (da <= radius + reach)], b[(db <= radius) & (db > radius - reach)], size)

    within(np.arange(len(prints)))
    return roots(parent, np.arange(len(prints)))


def half_of(prints: np.ndarray, half: int) -> np.ndarray:
    """The lower or the upper 32 bits of each fingerprint."""
    return prints >> np.uint64(32) if half else prints & np.uint64(0xFFFFFFFF)


def links(classes: DataFrame, work: Scratch, reach: int = MAX_DISTANCE, limit: int = MAX_LEAF) -> DataFrame:
    """Pairs (a, b), a > b, of fingerprints at a distance up to ``reach`` or connected by such; none is lost.

    ``classes`` is a written table with the distinct fingerprints, column print. Two of them within the
    reach differ in half of it or less in their lower or in their upper 32 bits, so each half has a tree
    of its own whose borders are that much thinner; in a leaf whole fingerprints decide. A leaf with
    more than ``limit`` fingerprints gets a tree over whole fingerprints, from a
    sample of the leaf, as long as a border parts it.
    """
    spark = classes.sparkSession
    total = classes.count()
    share = min(1.0, 1.5 * SAMPLE / max(total, 1)) * (1 << 31)
    drawn = F.pmod(F.xxhash64(F.lit("vantage"), "print"), F.lit(1 << 31))
    rows = classes.where(drawn < share).select("print").orderBy(drawn, "print").limit(SAMPLE).collect()
    sample = np.array([r.print for r in rows], dtype=np.int64).view(np.uint64)
    trees = spark.sparkContext.broadcast([build(half_of(sample, k), total, reach // 2) for k in (0, 1)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy()
            for k, tree in enumerate(trees.value):
                leaf, at = place(half_of(prints.view(np.uint64), k), tree, reach // 2)
                yield pa.RecordBatch.from_arrays([pa.array(2 * leaf + k), pa.array(prints[at])], names=["leaf", "print"])

    placed = work.keep(classes.select("print").mapInArrow(route, "leaf long, print long"), "placed")
    found = []
    for _ in range(SPLITS):
        split = _subtrees(placed, reach, limit)
        if not split:
            break
        own = F.broadcast(spark.createDataFrame([(leaf,) for leaf in split], "leaf long"))
        found.append(_leaf_links(placed.join(own, "leaf", "left_anti"), work, reach))
        placed = work.keep(_route_again(placed.join(own, "leaf", "left_semi"), split, reach), "placed")
    found.append(_leaf_links(placed, work, reach))
    return work.keep(reduce(DataFrame.unionByName, found).distinct(), "links")


def _subtrees(placed: DataFrame, reach: int, limit: int) -> dict[int, tuple[int, Node]]:
    """For each of the largest leaves above ``limit`` that a border parts: the number its own leaves begin with, and a
    tree over whole fingerprints, from a bounded sample of the leaf."""
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    large = {r.leaf: r.n for r in sizes.orderBy(F.desc("n"), "leaf").limit(SPLIT_AT_ONCE).collect()}
    if not large:
        return {}
    shares = [(leaf, int(min(1.0, SPLIT_SAMPLE / n) * (1 << 31))) for leaf, n in large.items()]
    wanted = F.broadcast(placed.sparkSession.createDataFrame(shares, "leaf long, share long"))
    drawn = F.pmod(F.xxhash64(F.lit("again"), "print"), F.lit(1 << 31))
    held: dict[int, list[int]] = {}
    for r in placed.join(wanted, "leaf").where(drawn < F.col("share")).select("leaf", "print").collect():
        held.setdefault(r.leaf, []).append(r.print)
    out, start = {}, 0
    for leaf, prints in sorted(held.items()):
        tree = build(np.sort(np.array(prints, dtype=np.int64)).view(np.uint64), large[leaf], reach)
        if isinstance(tree, Node):
            out[leaf] = (start, tree)
            start += leaves_of(tree)
    return out


def _route_again(placed: DataFrame, split: dict[int, tuple[int, Node]], reach: int) -> DataFrame:
    shared = placed.sparkSession.sparkContext.broadcast(split)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, prints = batch.column("leaf").to_numpy(), batch.column("print").to_numpy()
            for before in np.unique(held):
                own = prints[held == before]
                start, tree = shared.value[int(before)]
                leaf, at = place(own.view(np.uint64), tree, reach)
                yield pa.RecordBatch.from_arrays([pa.array(start + leaf), pa.array(own[at])], names=["leaf", "print"])

    return placed.mapInArrow(route, "leaf long, print long")


def _leaf_links(placed: DataFrame, work: Scratch, reach: int) -> DataFrame:
    """Links that connect what is connected in one leaf: at most one for each fingerprint."""

    def connected(leaf: pa.Table) -> pa.Table:
        prints = np.sort(leaf.column("print").to_numpy())
        first = components(prints.view(np.uint64), reach)
        linked = first != np.arange(len(prints))
        return pa.table({"a": prints[linked], "b": prints[first[linked]]})

    return work.keep(placed.groupBy("leaf").applyInArrow(connected, "a long, b long").distinct(), "leaf-links")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def connect(edges: DataFrame, work: Scratch) -> DataFrame:
    """Components of a graph (a, b), a > b: every node but the smallest of its component, with that one.

    Alternates two steps until nothing changes: each node tells its larger neighbours, then its
    smaller ones, the smallest node it knows. The number of rounds grows with the log of a path's length.
    """
    state = _state(edges)
    for _ in range(ROUNDS):
        if not state[0]:
            return edges
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        total = 2 * state[0]
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count(F.lit(1)).alias("n"))
        larger = attach(both, work.keep(least, "least"), ["a"], "n", total).where("b > a")
        edges = work.keep(larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "large-star")
        least = edges.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
        smaller = attach(edges, work.keep(least, "least"), ["a"], "n", total)
        told = smaller.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = smaller.select("a", F.col("least").alias("b"))
        edges = work.keep(told.unionByName(own).distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            return edges
    raise RuntimeError(f"no end after {ROUNDS} rounds")


def near_duplicates(
    docs: DataFrame, work: Scratch, words: int = WORDS, reach: int = MAX_DISTANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_hash, print, root, component_id of every row.

    Rows are linked if their fingerprints differ in ``reach`` bits or fewer; ``root`` is the smallest
    fingerprint of the component and ``component_id`` its smallest id. Null, empty and blank texts have
    fingerprint 0 and are linked like any others. Ids may repeat or be null (a component of null ids
    has a null id). An empty table gives an empty result. Very long texts are hashed whole, in parts of
    bounded size.
    """
    prints = work.keep(fingerprints(docs, words, id_col, text_col), "prints")
    classes = prints.groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    classes = work.keep(classes, "classes")
    named = named_components(connect(links(classes, work, reach), work), classes, "print", work)
    groups = (
        classes.join(named, "print", "left")
        .withColumn("component_id", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")))
        .withColumn("root", F.coalesce("root", "print"))
        .select("print", "n", "root", "component_id")
    )
    total = prints.count()
    return attach(prints, work.keep(groups, "groups"), ["print"], "n", total).select(
        "doc_id", "text_hash", "print", "root", "component_id"
    )


def named_components(stars: DataFrame, classes: DataFrame, node: str, work: Scratch) -> DataFrame:
    """node, root, component_id of every node that has a link; ``classes`` has the smallest id of each node as first."""
    heads = stars.groupBy(F.col("b").alias("root")).agg(F.count(F.lit(1)).alias("size"))
    member = stars.select(F.col("a").alias(node), F.col("b").alias("root"))
    members = work.keep(member.unionByName(heads.select(F.col("root").alias(node), "root")), "members")
    known = members.join(classes.select(node, "first"), node)
    heads = work.keep(known.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.min("first").alias("component_id")), "heads")
    return attach(members, heads, ["root"], "size", members.count()).select(node, "root", "component_id")


def verdicts(decided: DataFrame, work: Scratch) -> DataFrame:
    """What ``retain`` needs so that of each component the row with the smallest id stays (null ids last).

    ``decided`` is a written table. Of rows with the smallest id the smallest text_hash decides.
    """
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    groups = decided.groupBy("root").agg(F.count(F.lit(1)).alias("size"), best.alias("best")).where("size > 1")
    named = attach(decided, work.keep(groups, "groups"), ["root"], "size", decided.count())
    once = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    judged = named.withColumn("once", once).groupBy("doc_id", "text_hash", "once").agg(F.count(F.lit(1)).alias("n"))
    return judged.where("NOT once OR n > 1")


def op8_simhash(docs: DataFrame, work: Scratch) -> DataFrame:
    return near_duplicates(docs, work).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
