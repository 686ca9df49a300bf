"""Nearest neighbours by largest inner product: p-stable hashing, probed in the order of estimated success."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import SEED
from basketry.scratch import Scratch

NEIGHBOURS = 20
TABLES = 2
# Chance, by the hash's own statistics, that one table or another finds a neighbour as far as the last one wanted.
TARGET = 0.96
WIDTH = 1.0
# Probes of one table at most. Hashes are so few that a query gets by with them; one that doesn't is compared with all rows.
PROBES = 8192
# Of a sample's queries, the share that must get by, and the chance that a hash value's steps leave out.
GET_BY, LEFT_OUT = 0.95, 1e-3
# A task's block holds about so many vectors; buckets above that are dealt out over several blocks.
BLOCK = 16_384
HOT_BUCKETS = 100_000
QUERIES_AT_ONCE = 256
# A task holds so many queries at most, on average; with more of them a block's vectors go to several tasks.
QUERIES = 65_536
# The distance of a neighbour is learned from so many vectors at most.
SAMPLE, SAMPLE_QUERIES = 4096, 128
SALTS = 16
CODE_BITS = 10


@dataclass(frozen=True)
class Index:
    """Hash functions and what a probe's success is estimated by."""

    largest: float  # norm
    distance: float  # of a query and its last wanted neighbour, after the reduction to unit vectors
    direction: np.ndarray  # tables x (dimension + 1) x hashes
    shift: np.ndarray  # tables x hashes
    blocks: int
    hot: dict[tuple[int, int], int]  # (table, bucket) -> blocks it is dealt out over

    def parts(self, table: int, code: np.ndarray) -> np.ndarray:
        """Over how many blocks each bucket is dealt out: 1 for all but the hot ones."""
        own = sorted((c, p) for (of, c), p in self.hot.items() if of == table)
        if not own:
            return np.ones(len(code), dtype=np.int64)
        codes, parts = np.array(own, dtype=np.int64).T
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where(codes[at] == code, parts[at], 1)


def stored(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Unit vectors one dimension up, whose distance to a query's orders them by inner product."""
    scaled = vectors / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
    return np.column_stack([scaled, rest])


def asked(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True)), np.zeros(len(vectors))])


def pack(cells: np.ndarray) -> np.ndarray:
    """One number for each row of hash values, exact while they fit in CODE_BITS bits."""
    code = np.zeros(cells.shape[:-1], dtype=np.int64)
    for k in range(cells.shape[-1]):
        code = (code << CODE_BITS) | (np.clip(cells[..., k] + (1 << CODE_BITS - 1), 0, (1 << CODE_BITS) - 1))
    return code


def home(code: np.ndarray, blocks: int | np.ndarray) -> np.ndarray:
    """The block of a bucket within its table: a number below ``blocks``."""
    mixed = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype(np.int64) % blocks


def normal_below(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to seven places."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = np.exp(-(x**2) / 2) / math.sqrt(2 * math.pi) * t
    tail *= 0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    return np.where(x > 0, 1 - tail, tail)


def steps(spread: float) -> int:
    """How many cells away from a query's own a neighbour's hash value may be, either way, but for ``LEFT_OUT``."""
    return max(1, math.ceil(spread * NormalDist().inv_cdf(1 - LEFT_OUT / 2)))


def probes(values: np.ndarray, distance: float, target: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query's hash values (before rounding) the cells to visit, and each cell's chance of success.

    A neighbour's value is off by a normal amount with the neighbour's distance as its spread, so the
    chance of a cell is a product over the hashes. Cells come in descending order until their chances
    sum to ``target``, ``PROBES`` of them at most.
    """
    base = np.floor(values)
    spread = distance / WIDTH
    off = np.arange(-steps(spread), steps(spread) + 1)
    low = (off[None, None, :] - (values - base)[:, :, None]) / spread
    chance = normal_below(low + 1 / spread) - normal_below(low)
    out = []
    for row in range(len(values)):
        cells, best = np.zeros((1, 0), dtype=np.int64), np.ones(1)
        for k in range(values.shape[1]):
            product = (best[:, None] * chance[row, k][None, :]).ravel()
            order = np.argsort(-product, kind="stable")[:PROBES]
            cells = np.column_stack([cells[order // len(off)], off[order % len(off)]])
            best = product[order]
        enough = int(np.searchsorted(np.cumsum(best), target)) + 1
        out.append((base[row].astype(np.int64) + cells[:enough], best[:enough]))
    return out


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def vector_type(vectors: DataFrame, vector_col: str) -> str:
    """Single precision stays as it is, to move half as much; sums are in double precision anyway."""
    kind = vectors.select(vector_col).schema[0].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return "array<float>" if single else "array<double>"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    kind = vector_type(vectors, vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        finite & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("vector") == (common.size if common else 0))


def distinct_vectors(rows: DataFrame, neighbours: int) -> DataFrame:
    """vector and ids: of equal vectors the smallest ids, as many as any query can want besides itself.

    Equal vectors tie, so larger ids can't be among the nearest; a vector that many rows share
    becomes one.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    order = Window.partitionBy("vector", "salt").orderBy("vec_id")
    few = salted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= neighbours + 1)
    return few.groupBy("vector").agg(F.slice(F.sort_array(F.collect_set("vec_id")), 1, neighbours + 1).alias("ids"))


def alone(target: float) -> float:
    """The chance that one table must have so that all tables together have the target's."""
    return 1 - (1 - target) ** (1 / TABLES)


def falls_short(chances: np.ndarray, target: float) -> bool:
    return float(chances.sum()) < target - 1e-9


def gets_by(index: Index, vectors: np.ndarray, target: float) -> float:
    """The share of queries whose cells reach the target's chance in the first table."""
    values = (asked(vectors) @ index.direction[0] + index.shift[0]) / WIDTH
    found = probes(values, index.distance, alone(target))
    return 1 - sum(falls_short(c, alone(target)) for _, c in found) / len(found)


def fit(distinct: DataFrame, neighbours: int = NEIGHBOURS, target: float = TARGET, hashes: int | None = None) -> Index | None:
    """Choose hashes and learn the neighbours' distance from a bounded sample; None without vectors.

    With more vectors there are more ``hashes``, but never so many that a sample's queries need more
    than ``PROBES`` probes for the target's chance.
    """
    size = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, largest = distinct.agg(F.count(F.lit(1)), F.max(F.sqrt(size))).first()
    if not n:
        return None
    drawn = F.pmod(F.xxhash64("vector"), F.lit(1 << 31))
    thinned = distinct.where(drawn < min(1.0, 2.0 * SAMPLE / n) * (1 << 31))
    sample = np.array([r.vector for r in thinned.select("vector").orderBy(drawn).limit(SAMPLE).collect()])
    apart = asked(sample[:SAMPLE_QUERIES]) @ stored(sample, largest).T
    apart = np.sort(np.sqrt(np.maximum(0.0, 2 - 2 * apart)), axis=1)
    wanted = min(max(1, round(neighbours * len(sample) / n)), len(sample) - 1)
    distance = max(float(np.median(apart[:, wanted])), 1e-3)
    rng = np.random.default_rng(SEED)
    hashes = hashes or (min(max(round(math.log(max(n, 1) / 500, 4)), 3), 6) if n > 500 else 3)
    index = Index(
        float(largest),
        distance,
        rng.normal(size=(TABLES, sample.shape[1] + 1, hashes)),
        rng.uniform(0, WIDTH, size=(TABLES, hashes)),
        max(1, -(-n // BLOCK)),
        {},
    )
    while index.shift.shape[1] > 1 and gets_by(index, sample[:SAMPLE_QUERIES], target) < GET_BY:
        index = replace(index, direction=index.direction[:, :, :-1], shift=index.shift[:, :-1])
    return index


def buckets(vectors: np.ndarray, index: Index, table: int) -> np.ndarray:
    return pack(np.floor((vectors @ index.direction[table] + index.shift[table]) / WIDTH).astype(np.int64))


def with_hot(index: Index, distinct: DataFrame, n: int) -> Index:
    """The index with its large buckets noted: fewer than TABLES * n / limit, so below HOT_BUCKETS."""
    limit = max(BLOCK, -(-TABLES * n // HOT_BUCKETS))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = stored(matrix(batch.column("vector")), index.largest)
            for table in range(TABLES):
                code, count = np.unique(buckets(vectors, index, table), return_counts=True)
                yield pa.RecordBatch.from_pydict({"table": np.full(len(code), table, np.int32), "code": code, "n": count})

    counts = distinct.select("vector").mapInArrow(codes, "table int, code long, n long")
    large = counts.groupBy("table", "code").agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect()
    hot = {(r["table"], r["code"]): min(index.blocks, -(-r["n"] // BLOCK)) for r in large}
    return Index(index.largest, index.distance, index.direction, index.shift, index.blocks, hot)


def _place_vectors(index: Index, element: pa.DataType):
    schema = pa.schema([("block", pa.int64()), ("code", pa.int64()), ("vector", pa.list_(element)), ("ids", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = stored(matrix(batch.column("vector")), index.largest)
            for table in range(TABLES):
                code = buckets(vectors, index, table)
                block = home(code, index.blocks)
                parts = index.parts(table, code)
                at = np.flatnonzero(parts > 1)
                first = np.array([batch.column("ids")[int(i)][0].as_py() for i in at], dtype=np.int64)
                block[at] = (block[at] + home(first, parts[at])) % index.blocks
                arrays = [pa.array(table * index.blocks + block), pa.array(code), batch.column("vector"), batch.column("ids")]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    return work


def _place_queries(index: Index, target: float, element: pa.DataType):
    schema = pa.schema([("block", pa.int64()), ("query_id", pa.int64()), ("vector", pa.list_(element)), ("codes", pa.list_(pa.int64()))])
    wanted = alone(target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, queries = matrix(batch.column("vector")), batch.column("vec_id").to_pylist()
            for table in range(TABLES):
                values = (asked(vectors) @ index.direction[table] + index.shift[table]) / WIDTH
                for row, (cells, chances) in enumerate(probes(values, index.distance, wanted)):
                    if falls_short(chances, wanted):
                        if table == 0:  # every vector is in each table once
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.arange(index.blocks)),
                                    pa.array([queries[row]] * index.blocks, pa.int64()),
                                    pa.array([vectors[row]] * index.blocks, pa.list_(pa.float64())).cast(pa.list_(element)),
                                    pa.array([None] * index.blocks, pa.list_(pa.int64())),
                                ],
                                schema=schema,
                            )
                        continue
                    code = pack(cells)
                    block = home(code, index.blocks)
                    # All blocks of a hot bucket are visited.
                    times = index.parts(table, code)
                    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    code, block = np.repeat(code, times), (np.repeat(block, times) + step) % index.blocks
                    order = np.argsort(block, kind="stable")
                    own, starts = np.unique(block[order], return_index=True)
                    parts = np.split(code[order], starts[1:])
                    n = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(table * index.blocks + own),
                            pa.array([queries[row]] * n, pa.int64()),
                            pa.array([vectors[row]] * n, pa.list_(pa.float64())).cast(pa.list_(element)),
                            pa.array(parts, pa.list_(pa.int64())),
                        ],
                        schema=schema,
                    )

    return work


def _rank_block(neighbours: int):
    schema = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])

    def work(held: pa.Table, queries: pa.Table) -> pa.Table:
        if not held.num_rows or not queries.num_rows:
            return schema.empty_table()
        vectors, codes, ids = matrix(held.column("vector")), held.column("code").to_numpy(), held.column("ids").to_pylist()
        first = np.array([i[0] for i in ids], dtype=np.int64)
        kinds, bucket = np.unique(codes, return_inverse=True)
        members = np.split(np.argsort(bucket, kind="stable"), np.cumsum(np.bincount(bucket))[:-1])
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = queries.column("query_id").to_numpy()
        for at in range(0, len(names), QUERIES_AT_ONCE):
            part = queries.slice(at, QUERIES_AT_ONCE)
            asked_for = matrix(part.column("vector"))
            wanted = part.column("codes").combine_chunks()
            lengths = np.nan_to_num(wanted.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            owner = np.repeat(np.arange(len(wanted)), lengths)
            probed = wanted.flatten().to_numpy()
            found = np.minimum(np.searchsorted(kinds, probed), len(kinds) - 1)
            hit = kinds[found] == probed
            scores = np.full((len(wanted), len(vectors)), -np.inf)
            everything = wanted.is_null().to_numpy(zero_copy_only=False)
            scores[everything] = asked_for[everything] @ vectors.T
            for k in np.unique(found[hit]):
                who = owner[hit & (found == k)]
                scores[np.ix_(who, members[k])] = asked_for[who] @ vectors[members[k]].T
            most = min(neighbours + 1, len(vectors))
            best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
            # Of equal scores at the end of the list the smallest ids stay.
            last = np.take_along_axis(scores, best, axis=1).min(axis=1)
            row, col = np.nonzero((scores >= last[:, None]) & np.isfinite(scores))
            order = np.lexsort((first[col], -scores[row, col], row))
            row, col = row[order], col[order]
            near = np.arange(len(row)) - np.searchsorted(row, row) < most
            row, col = row[near], col[near]
            exact = np.einsum("ij,ij->i", asked_for[row], vectors[col])
            out.append((names[at + row], exact, col))
        query, score, col = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.Table.from_arrays(
            [pa.array(query), pa.array(score), pa.array([ids[c] for c in col], pa.list_(pa.int64()))], schema=schema
        )

    return work


def nearest(
    vectors: DataFrame,
    work: Scratch,
    query_filter,
    neighbours: int = NEIGHBOURS,
    target: float = TARGET,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that meets ``query_filter`` the candidates found with the largest inner product.

    Candidates are all other rows. Rows with a null id or vector, a zero vector or one with a null or
    non-finite component take no part, nor do vectors of another length than most. Equal scores rank
    by id; of several vectors with one id the best counts. Without usable vectors the result is empty.

    Equal vectors are one entry of the index. Every vector is hashed in each table; a query visits
    the buckets that most likely hold its neighbours, up to the target chance, and what they hold is
    ranked by the inner product of the original vectors, block by block. A query that can't reach the
    chance with ``PROBES`` probes is compared with all vectors instead. Very long vectors are no special
    case, and a repeated row is a query once.
    """
    rows = work.keep(usable(vectors, id_col, vector_col), "usable")
    distinct = work.keep(distinct_vectors(rows, neighbours), "distinct")
    index = fit(distinct, neighbours, target)
    spark = vectors.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = with_hot(index, distinct, distinct.count())
    kind = vector_type(rows, "vector")
    element = pa.float32() if kind == "array<float>" else pa.float64()
    held = distinct.mapInArrow(_place_vectors(index, element), f"block long, code long, vector {kind}, ids array<long>")
    queries = rows.where(query_filter(F.col("vec_id"))).dropDuplicates(["vec_id", "vector"])
    # With very many queries those of a block go to several tasks, each with the block's vectors.
    tasks = max(1, -(-queries.count() // QUERIES))
    held = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    queries = queries.mapInArrow(_place_queries(index, target, element), f"block long, query_id long, vector {kind}, codes array<long>")
    queries = queries.withColumn("share", F.pmod(F.xxhash64("query_id"), F.lit(tasks)).cast("int"))
    found = (
        held.groupBy("block", "share")
        .cogroup(queries.groupBy("block", "share"))
        .applyInArrow(_rank_block(neighbours), "query_id long, score double, ids array<long>")
    )
    each = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A neighbour is found once in a table at most, so the best of all tables are among so many rows.
    few = each.withColumn("place", F.row_number().over(best)).where(F.col("place") <= neighbours * TABLES)
    once = Window.partitionBy("query_id", "vec_id").orderBy(F.desc("score"))
    single = few.withColumn("again", F.row_number().over(once)).where("again = 1")
    return (
        single.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_nearest(vectors: DataFrame, work: Scratch) -> DataFrame:
    return nearest(vectors, work, lambda vec_id: vec_id % 20 == 0)
