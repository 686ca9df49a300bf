"""Best-fit packing of token sequences by bin completion with branch and bound."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm.bpe import ID, SPACE, Encoder, share_file
from basketry.llm.common import texts
from basketry.llm.ngrams import slices
from basketry.scratch import Scratch

CAPACITY = 4096
END = 1
# Rows of one length get their places by so many parts, since a length may hold a third of all rows.
PARTS = 32

# The search: fillings kept for one bin, looks at pieces for them, and looks in all before the best plan so far is taken.
FILLINGS = 3
FILLING_STEPS = 2000
MAX_STEPS = 300_000

LETTERS = re.compile(r"[a-z\x80-\U0010ffff]+|[^a-z\x80-\U0010ffff \t-\r]+")
CHUNKS = re.compile(f"[^{SPACE}]+")
# Fixed value: what the tokenizer's own marks for the start and end of a text begin with.
MARK = "<|"


def cut_words(text: str) -> list[str]:
    """Pieces whose ids, one after the other, are those of the whole text; white space is dropped.

    The tokenizer keeps letters and other characters apart, unless an apostrophe stands between them or
    they spell one of its marks, which begin with ``MARK`` and hold no white space. So where there is
    neither and all characters beyond ASCII are letters, in lower case too, runs of letters are pieces
    (A-Z in lower case, as the tokenizer has them); else what stands between white space.
    """
    plain = text.encode().lower().decode()
    if "'" not in plain and MARK not in plain and (plain.isascii() or all(map(stays_letters, set(plain)))):
        return LETTERS.findall(plain)
    return CHUNKS.findall(text)


def stays_letters(c: str) -> bool:
    return c <= "\x7f" or c.isalpha() and c.lower().isalpha()


_encoders: dict[int, Encoder] = {}


def encoder(content: bytes) -> Encoder:
    """The encoder of a tokenizer file, built once in each process."""
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = Encoder(Tokenizer.from_str(content.decode()), cut_words)
    return _encoders[key]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and tag: the ids of each text and an end mark, cut at ``capacity``."""
    content = share_file(docs.sparkSession, tokenizer_path)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    end = np.array([END], dtype=ID).tobytes()
    step = capacity * ID.itemsize

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, part in slices(batch):
                rows = [
                    (doc, at // step, at // ID.itemsize, len(piece) // ID.itemsize, zlib.crc32(piece))
                    for doc, own in zip(ids[first:], encode([t or "" for t in part]), strict=False)
                    for data in [own + end]
                    for at in range(0, len(data), step)
                    for piece in [data[at : at + step]]
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    tagged = texts(docs, id_col, text_col).mapInArrow(work, schema)
    return tagged.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int"))


@dataclass
class Stock:
    """How many pieces of each length are left. ``mask`` has a bit for each length that is."""

    counts: dict[int, int]
    mask: int = field(init=False)

    def __post_init__(self):
        self.counts = {length: n for length, n in self.counts.items() if n > 0}
        self.mask = sum(1 << length for length in self.counts)

    def largest(self, limit: int) -> int:
        """The largest length left that is not above ``limit``; 0 if there is none."""
        held = self.mask & ((1 << (max(limit, 0) + 1)) - 1)
        return held.bit_length() - 1 if held else 0

    def change(self, filling: dict[int, int], times: int) -> None:
        """Take ``filling`` out ``times`` times; with a negative number put it back."""
        for length, n in filling.items():
            left = self.counts.get(length, 0) - n * times
            if left:
                self.counts[length] = left
                self.mask |= 1 << length
            else:
                self.counts.pop(length, None)
                self.mask &= ~(1 << length)

    def times(self, filling: dict[int, int]) -> int:
        return min(self.counts[length] // n for length, n in filling.items())


def best_fit(stock: Stock, first: int, capacity: int) -> dict[int, int]:
    """One bin around ``first``: again and again the largest piece that still fits."""
    filling, room = Counter({first: 1}), capacity - first
    length = stock.largest(min(first, room))
    while length:
        n = min(room // length, stock.counts[length] - filling[length])
        if n:
            filling[length] += n
            room -= n * length
        length = stock.largest(min(length - 1, room))
    return dict(filling)


def fillings(stock: Stock, first: int, capacity: int, worst: int) -> tuple[list[tuple[int, dict[int, int]]], int]:
    """(waste, filling) of bins around the largest piece, least waste first, with at most ``worst`` waste; and the looks taken.

    A filling is dominated, and left out, if one of its pieces could give way to a larger one that is
    left and fits. Large pieces are tried first, so small ones stay for later bins; a piece that fills
    what room there is is seen at once. The first filling without waste ends the search, or else
    ``FILLING_STEPS`` looks do; the ``FILLINGS`` best ones found by then count.
    """
    found: list[tuple[int, dict[int, int]]] = []
    chosen: Counter[int] = Counter({first: 1})
    steps = 0

    def dominated(waste: int) -> bool:
        for length in chosen:
            if length != first and waste:
                larger = stock.largest(length + waste)
                if larger > length and stock.counts[larger] > chosen[larger]:
                    return True
        return False

    def search(limit: int, room: int) -> bool:
        nonlocal steps
        steps += 1
        if room <= limit and stock.counts.get(room, 0) > chosen[room]:
            found.append((0, dict(chosen + Counter({room: 1}))))
            return True
        length = stock.largest(min(limit, room))
        if not length or not room:
            if room <= worst and not dominated(room):
                found.append((room, dict(chosen)))
            return room == 0 or steps > FILLING_STEPS
        while length:
            most = min(room // length, stock.counts[length] - chosen[length])
            for n in range(most, 0, -1):
                chosen[length] += n
                done = search(length - 1, room - n * length)
                chosen[length] -= n
                if not chosen[length]:
                    del chosen[length]
                if done or steps > FILLING_STEPS:
                    return True
            length = stock.largest(min(length - 1, room))
        return False

    search(first, capacity - first)
    found.sort(key=lambda f: f[0])
    return found[:FILLINGS], steps


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: the best of several.

    Of pieces above a k-th of the capacity fewer than k share a bin. And for each size up to half: pieces
    too large to share a bin with one of that size, other pieces above half, and what of the rest, down to
    that size, the latter's bins have no room for.
    """
    sizes = np.array(sorted(counts), dtype=np.int64)
    if not len(sizes):
        return 0
    n = np.array([counts[int(s)] for s in sizes], dtype=np.int64)
    total = int((sizes * n).sum())
    best = max(-(-total // capacity), *(-(-int(n[k * sizes > capacity].sum()) // (k - 1)) for k in range(2, 9)))
    for size in sizes[2 * sizes <= capacity].tolist():
        alone, large = sizes > capacity - size, (2 * sizes > capacity) & (sizes <= capacity - size)
        rest = (2 * sizes <= capacity) & (sizes >= size)
        room = int(n[large].sum()) * capacity - int((sizes * n)[large].sum())
        more = max(0, -(-(int((sizes * n)[rest].sum()) - room) // capacity))
        best = max(best, int(n[alone].sum() + n[large].sum()) + more)
    return best


Plan = list[tuple[int, dict[int, int]]]


def bins(plan: Plan) -> int:
    return sum(times for times, _ in plan)


def greedy(counts: dict[int, int], capacity: int) -> Plan:
    """The incumbent: best fit by descending length."""
    stock, plan = Stock(dict(counts)), []
    while stock.mask:
        filling = best_fit(stock, stock.mask.bit_length() - 1, capacity)
        times = stock.times(filling)
        stock.change(filling, times)
        plan.append((times, filling))
    return plan


def complete(counts: dict[int, int], capacity: int = CAPACITY, max_steps: int = MAX_STEPS) -> Plan:
    """(times, filling) of all bins, as few as the search finds.

    Bins are completed around the largest piece left; a filling is used as often as the stock allows or,
    when that leads nowhere, once. A branch ends when its waste shows that it can't beat the best plan
    so far; the search ends at a plan that no other can beat, or after ``max_steps`` looks at pieces:
    then the best plan so far is taken, which may use more bins than need be. It never leaves a piece out.
    """
    counts = {length: n for length, n in counts.items() if n}
    total = sum(length * n for length, n in counts.items())
    least = least_bins(counts, capacity)
    best = greedy(counts, capacity)
    stock, plan, looks = Stock(dict(counts)), [], 0
    waste, open_ = 0, []

    def spare() -> int:
        """Waste that a plan with fewer bins than the best may still have."""
        return (bins(best) - 1) * capacity - total - waste

    def options() -> Iterator[tuple[int, dict[int, int], int]]:
        nonlocal looks
        first = stock.mask.bit_length() - 1
        fill = best_fit(stock, first, capacity)
        found, steps = fillings(stock, first, capacity, capacity)
        looks += steps + len(fill)
        found = found or [(capacity - sum(k * n for k, n in fill.items()), fill)]
        often = [(lost, filling, stock.times(filling)) for lost, filling in found]
        return iter([*often, *((lost, filling, 1) for lost, filling, times in often if times > 1)])

    if bins(best) == least or not counts:
        return best
    open_.append(options())
    while open_ and looks < max_steps:
        for lost, filling, times in open_[-1]:
            if lost * times <= spare():
                break
        else:
            open_.pop()
            if plan:
                times, filling = plan.pop()
                stock.change(filling, -times)
                waste -= times * (capacity - sum(length * n for length, n in filling.items()))
            continue
        stock.change(filling, times)
        plan.append((times, filling))
        waste += times * (capacity - sum(length * n for length, n in filling.items()))
        if stock.mask:
            open_.append(options())
            continue
        if bins(plan) < bins(best):
            best = list(plan)
        if bins(best) == least:
            break
        times, filling = plan.pop()
        stock.change(filling, -times)
        waste -= times * (capacity - sum(length * n for length, n in filling.items()))
    return best


def allocation(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, sequence, each, offset): of the pieces of a length, numbered from 0, those
    from ``from`` to below ``to`` go into sequences from ``sequence`` on, ``each`` into one, from ``offset`` on."""
    rows, used, sequence = [], Counter(), 0
    for times, filling in plan:
        offset = 0
        for length, n in sorted(filling.items(), reverse=True):
            rows.append((length, used[length], used[length] + n * times, sequence, n, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    return rows


def pack(docs: DataFrame, work: Scratch, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all texts into as few sequences as the search finds, each with at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Texts are encoded
    whole, with an end mark; only longer ones are cut. A null or empty text is its end mark alone. Ids
    may be null or repeat, equal rows are packed one by one, an empty table gives an empty result.

    What the plan needs is how many pieces have each length: at most ``capacity`` numbers, whatever
    the table's size. The driver plans with these, and each piece finds its place by its number among
    those of its length. A plan has fewer fillings than capacity * ln(capacity), so it is broadcast.
    """
    spark = docs.sparkSession
    rows = work.keep(pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    loads = work.keep(rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "loads")
    counts = {r.length: r.n for r in loads.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        allocation(complete(counts, capacity)),
        "plan_length long, from long, to long, sequence long, each long, plan_offset long",
    )
    earlier = Window.partitionBy("length").orderBy("part")
    starts = loads.withColumn("before", F.sum("n").over(earlier) - F.col("n")).drop("n")
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    placed = rows.withColumn("number", F.row_number().over(within) - 1).join(F.broadcast(starts), ["length", "part"])
    placed = placed.withColumn("number", F.col("number") + F.col("before"))
    planned = (F.col("length") == F.col("plan_length")) & (F.col("number") >= F.col("from")) & (F.col("number") < F.col("to"))
    at = F.col("number") - F.col("from")
    return placed.join(F.broadcast(plan), planned).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("plan_offset") + at % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def op6_packing(docs: DataFrame, work: Scratch) -> DataFrame:
    import public_tokenizers

    return pack(docs, work, public_tokenizers.path("word_bpe_49k.json"))
