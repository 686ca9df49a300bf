"""Alignment of two tokenizers: which tokens overlap in each text, and how often each pair does in all texts.

Counting spills: a task sorts its (pair, document) records side-major, cuts them by radix into parts
and compresses each part's run with zstd. Runs of a part are merged through a heap, a bounded number at
a time, until every part has one list of pairs with their counts; as the second side comes first in the
order, a token's highest count is known once its last pair has passed. The runs then meet the counts of
their part and what they make of each document goes back to the task's documents.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm.bpe import SPACE, byte_characters, share_file
from basketry.llm.common import texts
from basketry.llm.ngrams import slices
from basketry.scratch import Scratch

# Parts by the low bits of the second side's id; records and documents of a run; runs merged, or counted back, at once.
PARTS = 64
RUN_RECORDS, RUN_DOCUMENTS = 1 << 20, 1 << 15
FAN_IN, RUNS_AT_ONCE = 64, 512
FRAME = 1 << 16
# Pieces of text whose alignment a worker remembers, if short.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 48
LEVEL = 3
SIDE = 32
LOW = (1 << SIDE) - 1

# Neither tokenizer has a token that goes on over a space after another character, so texts are cut there.
OTHER_SPACE = SPACE.replace(r"\t-\r ", r"\t-\r")
CHUNK = re.compile(f"[{SPACE}]*+(?:[^{SPACE}]++(?:[{OTHER_SPACE}][{SPACE}]*+)?+)++|[{SPACE}]++")
PIECE_SPACE = "▁"
# A chunk's numbers of first and second ids in one, so that they are summed at once; its groups as text; its links as longs.
BOTH = 40
Aligned = tuple[int, bytes, bytes]


class Aligner:
    """Ids, groups and links of texts under both tokenizers, in one process."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.first = Tokenizer.from_str(byte_level.decode())
        self.first.encode_special_tokens = True  # their strings in a text are ordinary text
        code = {c: b for b, c in enumerate(byte_characters())}
        self.first_bytes = [b""] * self.first.get_vocab_size()
        for token, i in self.first.get_vocab(with_added_tokens=False).items():
            self.first_bytes[i] = bytes(code[c] for c in token if c in code)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(name[3:-1], 16)]) if self.second.is_byte(i) else name.replace(PIECE_SPACE, " ").encode() for i, name in enumerate(names)
        ]
        # A lone space is what the second tokenizer puts in front of any text.
        self.space = self.second.encode("a ")[len(self.second.encode("a")) :]
        self.known: dict[str, Aligned | bool] = {}

    def _aligned(self, chunk: str, first: Sequence[int], second: Sequence[int]) -> Aligned | bool:
        """What a chunk adds to its text; False if bytes differ."""
        data = chunk.encode()
        a, b = [self.first_bytes[i] for i in first], [self.second_bytes[i] for i in second]
        if b"".join(a) != data or b"".join(b) != data:
            return False
        links, groups = [], []
        i = j = from_i = from_j = 0
        end_a, end_b, last = len(a[0]), len(b[0]), len(data)
        while True:
            links.append(second[j] << SIDE | first[i])
            if end_a == end_b:
                if i == from_i and j == from_j:
                    groups.append(f"{first[i]}|{second[j]}")
                else:
                    groups.append(f"{','.join(map(str, first[from_i : i + 1]))}|{','.join(map(str, second[from_j : j + 1]))}")
                i, j = i + 1, j + 1
                if end_a == last:
                    break
                from_i, from_j = i, j
                end_a += len(a[i])
                end_b += len(b[j])
            elif end_a < end_b:
                i += 1
                end_a += len(a[i])
            else:
                j += 1
                end_b += len(b[j])
        return len(first) << BOTH | len(second), ";".join(groups).encode(), array("q", links).tobytes()

    def _look_up(self, chunks: Iterable[str]) -> dict[str, Aligned | bool]:
        fresh = list(chunks)
        out = {}
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            encoded = self.first.encode_batch_fast(part, add_special_tokens=False)
            # Chunks begin with a space, which the second tokenizer puts in front itself.
            others = self.second.encode([c[1:] for c in part], num_threads=1)
            out.update(
                (c, self._aligned(c, e.ids, ids if len(c) > 1 else self.space)) for c, e, ids in zip(part, encoded, others, strict=True)
            )
        return out

    def __call__(self, batch: Sequence[str | None]) -> list[tuple[int, int, int, int, str, np.ndarray]]:
        """(n_a, n_b, n_groups, n_links, digest of the groups, links) of each text; zeros without tokens."""
        cut = [CHUNK.findall(" " + t) if t else [] for t in batch]
        looked_up = [list(map(self.known.get, chunks)) for chunks in cut]
        fresh = self._look_up({c for chunks, got in zip(cut, looked_up, strict=True) for c, g in zip(chunks, got, strict=True) if g is None})
        out = []
        for chunks, own in zip(cut, looked_up, strict=True):
            if None in own:
                own = [fresh[c] if g is None else g for c, g in zip(chunks, own, strict=True)]
            if not own or False in own:
                out.append((0, 0, 0, 0, "", np.zeros(0, np.int64)))
                continue
            sizes, groups, links = zip(*own, strict=True)
            n_a, n_b = divmod(sum(sizes), 1 << BOTH)
            spelled, keys = b";".join(groups), np.frombuffer(b"".join(links), dtype=np.int64)
            out.append((n_a, n_b, spelled.count(b"|"), len(keys), sha256(spelled).hexdigest(), keys))
        if len(self.known) < REMEMBERED:
            self.known.update((c, a) for c, a in fresh.items() if len(c) <= LONGEST_REMEMBERED)
        return out


_aligners: dict[tuple[int, int], Aligner] = {}


def aligner(byte_level: bytes, pieces: bytes) -> Aligner:
    """The aligner of two tokenizer files, built once in each process."""
    key = (hash(byte_level), hash(pieces))
    if key not in _aligners:
        _aligners[key] = Aligner(byte_level, pieces)
    return _aligners[key]


def squeeze(*columns: np.ndarray) -> bytes:
    """Whole numbers of equal length, each column as its differences, compressed in frames that can be read one by one."""
    out = []
    for at in range(0, len(columns[0]), FRAME):
        part = [np.diff(c[at : at + FRAME], prepend=np.int64(0)).astype("<i8").tobytes() for c in columns]
        frame = zstandard.compress(b"".join(part), LEVEL)
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def frames(data: bytes, columns: int) -> Iterator[list[np.ndarray]]:
    at = 0
    while at < len(data):
        end = at + 4 + int.from_bytes(data[at : at + 4], "little")
        part = np.frombuffer(zstandard.decompress(data[at + 4 : end]), dtype="<i8").reshape(columns, -1)
        yield list(np.cumsum(part, axis=1))
        at = end


def whole(data: bytes, columns: int) -> list[np.ndarray]:
    held = [np.zeros((columns, 0), dtype=np.int64), *(np.array(f) for f in frames(data, columns))]
    return list(np.concatenate(held, axis=1))


ROWS = pa.schema(
    [("run", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("part", pa.int32()), ("pairs", pa.binary()), ("records", pa.binary())]
)
ROWS_SQL = "run long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, part int, pairs binary, records binary"


class Run:
    """What a task has gathered since its last run."""

    def __init__(self, number: int):
        self.number, self.documents, self.records = number, 0, 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, links: np.ndarray) -> int:
        keys, times = np.unique(links, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.places.append(np.full(len(keys), self.documents, dtype=np.int64))
        self.records += len(keys)
        self.documents += 1
        return self.documents - 1

    def rows(self) -> pa.RecordBatch:
        """A row for each part: its pairs with their counts, and its records (pair, document, times) in that order."""
        keys, times, places = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (self.keys, self.times, self.places))
        part = (keys >> SIDE) % PARTS
        order = np.lexsort((places, keys, part))
        keys, times, places, part = keys[order], times[order], places[order], part[order]
        out = []
        for own in np.unique(part):
            low, high = np.searchsorted(part, [own, own + 1])
            k, t, p = keys[low:high], times[low:high], places[low:high]
            pairs, first = np.unique(k, return_index=True)
            out.append((int(own), squeeze(pairs, np.add.reduceat(t, first)), squeeze(k, p, t)))
        number, pairs, records = zip(*out, strict=True) if out else ((), (), ())
        columns = {"run": [self.number] * len(out), "part": number, "pairs": pairs, "records": records}
        return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * len(out)), f.type) for f in ROWS], schema=ROWS)


def _spill(byte_level, pieces):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(byte_level.value, pieces.value)
        task = TaskContext.get().partitionId() << 32
        run = Run(task)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, part in slices(batch):
                found = align(part)
                rows = [(run.number, run.add(own[-1]), doc, *own[:-1]) for doc, own in zip(ids[start:], found, strict=False)]
                columns = [*zip(*rows, strict=True), *[[None] * len(rows)] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROWS, strict=True)], schema=ROWS)
                if run.records >= RUN_RECORDS or run.documents >= RUN_DOCUMENTS:
                    yield run.rows()
                    run = Run(run.number + 1)
        yield run.rows()

    return work


def _entries(data: bytes) -> Iterator[tuple[int, int]]:
    for keys, counts in frames(data, 2):
        yield from zip(keys.tolist(), counts.tolist(), strict=True)


def merged(runs: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs with their counts over all runs, in order: a heap holds the next pair of each run."""
    keys: list[int] = []
    counts: list[int] = []
    for key, count in heapq.merge(*map(_entries, runs)):
        if keys and keys[-1] == key:
            counts[-1] += count
            continue
        if len(keys) == FRAME:
            yield np.array(keys, dtype=np.int64), np.array(counts, dtype=np.int64)
            keys, counts = [], []
        keys.append(key)
        counts.append(count)
    yield np.array(keys, dtype=np.int64), np.array(counts, dtype=np.int64)


def _merge(group: pa.Table) -> pa.Table:
    data = b"".join(squeeze(*part) for part in merged(group.column("pairs").to_pylist()) if len(part[0]))
    return pa.table({"part": group.column("part")[:1], "run": group.column("group")[:1], "pairs": pa.array([data], pa.binary())})


def pair_counts(spilled: DataFrame, work: Scratch) -> tuple[DataFrame, int]:
    """(part, run, pairs) with one row for each part, and the number of runs of the fullest part.

    ``FAN_IN`` runs are merged in a task, then what they gave, until one is left: a task never holds
    more than that many runs, which it reads frame by frame.
    """
    runs = spilled.select("part", "run", "pairs")
    most = held = runs.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    first = True
    while held > 1 or first:
        groups = -(-held // FAN_IN)
        keyed = runs.withColumn("group", F.pmod(F.xxhash64("run", "part"), F.lit(max(groups, 1))))
        runs = work.keep(keyed.groupBy("part", "group").applyInArrow(_merge, "part int, run long, pairs binary"), "merged")
        held, first = groups, False
    return runs, most


def _contributions(runs: pa.Table, counted: pa.Table) -> pa.Table:
    """For each run what its records of one part give its documents: links at their second id's highest count, and sums."""
    keys, counts = (np.concatenate(x) for x in zip(*(whole(d, 2) for d in counted.column("pairs").to_pylist()), strict=True))
    side = keys >> SIDE
    first = np.flatnonzero(np.diff(side, prepend=-1))
    highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(side))) if len(first) else counts
    best, out = (counts == highest).astype(np.int64), []
    for run, data in zip(runs.column("run").to_pylist(), runs.column("records").to_pylist(), strict=True):
        own, places, times = whole(data, 3)
        at = np.searchsorted(keys, own)
        order = np.argsort(places, kind="stable")
        held, start = np.unique(places[order], return_index=True)
        sums = [np.add.reduceat((x[at] * times)[order], start) for x in (best, counts)]
        out.append((run, squeeze(held, *sums)))
    number, given = zip(*out, strict=True) if out else ((), ())
    return pa.table({"run": pa.array(number, pa.int64()), "given": pa.array(given, pa.binary())})


RESULT = [f for f in ROWS if f.name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
RESULT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(documents: pa.Table, given: pa.Table) -> pa.Table:
    documents = documents.sort_by("place")
    best, total = (np.zeros(documents.num_rows, dtype=np.int64) for _ in range(2))
    for data in given.column("given").to_pylist():
        places, some_best, some = whole(data, 3)
        best[places] += some_best
        total[places] += some
    columns = {f.name: documents.column(f.name) for f in RESULT}
    return pa.table({**columns, "n_best": best, "count_sum": total, "groups_sha256": documents.column("groups_sha256")})


def align(
    docs: DataFrame, work: Scratch, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): one row for every document, and the counts of all linked pairs of ids.

    A document's tokens are those of a space and the whole text under a byte-level tokenizer (a) and
    a piece tokenizer (b), without special tokens. Places where tokens of both end cut them into groups
    (n_groups, groups_sha256); tokens whose bytes overlap are linked (n_links). A pair's count is the
    number of links that hold it in all documents. n_best counts a document's links whose pair is the
    commonest, or as common, of its second id; count_sum adds their counts.

    Null and empty texts, and texts that one of the tokenizers doesn't give back byte by byte, have no
    tokens: zeros and an empty text for the digest. Very long texts are read whole, cut before spaces
    only in memory. Ids may be null or repeat, every row gives a row and counts; an empty table gives
    empty results.

    A run holds a bounded number of records. Pairs are counted within it first, so a pair that most
    documents share comes once for each run; parts are merged a bounded number of runs at a time.
    """
    spark = docs.sparkSession
    byte_level, pieces = share_file(spark, byte_level_path), share_file(spark, pieces_path)
    spilled = work.keep(texts(docs, id_col, text_col).mapInArrow(_spill(byte_level, pieces), ROWS_SQL), "spilled")
    documents, runs = spilled.where("part IS NULL").drop("part", "pairs", "records"), spilled.where("part IS NOT NULL")
    counted, most = pair_counts(runs, work)
    salts = F.lit(max(1, -(-most // RUNS_AT_ONCE)))
    salted = runs.select("run", "part", "records", F.pmod(F.xxhash64("run"), salts).alias("salt"))
    copies = counted.select("part", "pairs", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)).alias("salt"))
    given = (
        salted.groupBy("part", "salt").cogroup(copies.groupBy("part", "salt")).applyInArrow(_contributions, "run long, given binary")
    )
    result = documents.groupBy("run").cogroup(work.keep(given, "given").groupBy("run")).applyInArrow(_finish, RESULT_SQL)
    return result, counted.mapInArrow(_pairs, "a int, b int, count long")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("pairs").to_pylist():
            for keys, counts in frames(data, 2):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((keys & LOW).astype(np.int32)), pa.array((keys >> SIDE).astype(np.int32)), pa.array(counts)], names=["a", "b", "count"]
                )


def op11_alignment(docs: DataFrame, work: Scratch) -> DataFrame:
    import public_tokenizers

    return align(docs, work, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]
