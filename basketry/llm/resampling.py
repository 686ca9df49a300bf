"""Importance resampling towards a target: texts are weighed by hashed word n-grams and drawn by perturbed weight.

A batch's texts are joined with a separator between them and one pass of a pattern finds all words;
the place of each word among the texts' offsets tells whose it is, and n-grams that reach over the end
of a text are masked before they are counted.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import append_columns, texts
from basketry.llm.ngrams import segments, slices
from basketry.operators import selection
from basketry.operators.ordering import asc, desc
from basketry.operators.windows import global_window
from basketry.scratch import Scratch

LONGEST = 3
BUCKETS = 10_000
SHARE = (5, 100)
LEAST_WORDS = 20
SEED = 42
# In UTF-8 all bytes of characters beyond ASCII are 0x80 and above, so bytes and characters give the same words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\n"


class Words:
    """The words of several texts, and whose they are."""

    def __init__(self, batch: Sequence[str | None]):
        data = [(t or "").encode().lower() for t in batch]
        starts = np.cumsum([0, *(len(d) + len(SEPARATOR) for d in data)])[:-1]
        found = list(WORD.finditer(SEPARATOR.join(data)))
        self.texts = len(data)
        self.words = [m.group() for m in found]
        at = np.fromiter((m.start() for m in found), dtype=np.int64, count=len(found))
        self.owner = np.searchsorted(starts, at, side="right") - 1

    def features(self, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length (bucket, position of the last word) of all runs of words of one text."""
        spaced = [b" " + w for w in self.words]
        # A checksum goes on from that of the words before, so no n-gram is ever put together.
        sums = list(map(zlib.crc32, self.words))
        for length in range(1, LONGEST + 1):
            if length > 1:
                sums = list(map(zlib.crc32, spaced[length - 1 :], sums))
            last = np.arange(length - 1, len(self.words))
            whole = self.owner[last] == self.owner[: len(last)]
            yield (np.fromiter(sums, dtype=np.int64, count=len(last)) % buckets)[whole], last[whole]


def parts(batch: Sequence[str | None]) -> Iterator[tuple[Words, int, bool]]:
    """(words, how many of them were counted before, whether the texts begin here).

    A very long text comes in parts; each begins with the last words of the part before, so that
    n-grams over the border are found once.
    """
    if len(batch) > 1:
        yield Words(batch), 0, True
        return
    held: list[bytes] = []
    for k, segment in enumerate(segments(batch[0] or "")):
        words = Words([b" ".join(held).decode() + " " + segment])
        yield words, len(held), k == 0
        held = words.words[-(LONGEST - 1) :]


def _counts(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, part in slices(batch):
                for words, known, _ in parts(part):
                    for bucket, last in words.features(buckets):
                        counts += np.bincount(bucket[last >= known], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": counts[some]})

    return work


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends its sums, the driver gets ``buckets`` numbers."""
    found = texts(docs, id_col, text_col).select("text").mapInArrow(_counts(buckets), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of how much likelier a bucket is in the target, smoothed by one, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(batch: Sequence[str | None], gain: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, n_features and weight (the sum of its features' gains) of each text."""
    out = {name: np.zeros(len(batch), dtype=np.int64) for name in ("n_words", "n_features", "weight")}
    for words, known, _ in parts(batch):
        out["n_words"] += np.bincount(words.owner[known:], minlength=words.texts)
        for bucket, last in words.features(len(gain)):
            fresh = last >= known
            owner = words.owner[last[fresh]]
            out["n_features"] += np.bincount(owner, minlength=words.texts)
            # Whole numbers far below 2**53, so their sums are exact.
            out["weight"] += np.bincount(owner, weights=gain[bucket[fresh]], minlength=words.texts).astype(np.int64)
    return out


def perturbation(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel draw from the id alone, times 1000 and rounded down. A null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    work: Scratch,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``.

    Drawn without replacement: of the rows with ``least_words`` words or more the given share (rounded
    down) with the highest scores, a score being the weight plus a draw that hangs on the id. ``rank``
    counts the drawn rows from 1, ties go to the smaller id (null ids last); it is null for the others.
    Null and empty texts have no words, weight 0 and are never drawn; very long texts are read whole, in
    parts. Repeated rows have equal scores and are drawn one by one, rows of one id by weight then. Empty
    tables are fine on either side: without a target all buckets weigh by the source alone.

    All counts are over all rows. Texts are read twice and never shuffled; the driver sees one number
    for each bucket. The lowest drawn score is found by histograms, and only drawn rows are sorted.
    """
    source = bucket_counts(docs, buckets, id_col, text_col)
    wanted = bucket_counts(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")), buckets)
    gain = docs.sparkSession.sparkContext.broadcast(gains(source, wanted))
    schema = "n_words long, n_features long, weight long"
    rows = append_columns(texts(docs, id_col, text_col), lambda batch: weigh(batch, gain.value), schema, drop_text=True)
    rows = work.keep(rows.withColumn("score", F.col("weight") + perturbation(F.col("doc_id"))), "weighed")

    order = [desc("score"), asc("doc_id"), desc("weight"), asc("n_features"), asc("n_words")]
    long_enough = F.col("n_words") >= least_words
    able = rows.where(long_enough)
    at = selection.positions(able, [b.column for b in order])
    draw = share[0] * at.rows // share[1]
    if not draw:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    ((border,),) = selection.borders(able, [order], [[draw]], at)
    beyond = ~long_enough | selection.after([at.of(b) for b in order], border)
    # Rows that tie with the last drawn one in everything may be too many by then.
    ranked = global_window(rows.where(~beyond), order, work, rank="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")).cast("long"))
    return ranked.unionByName(rows.where(beyond).withColumn("rank", F.lit(None).cast("long")))


def op13_resampling(docs: DataFrame, benchmark: DataFrame, work: Scratch) -> DataFrame:
    return resample(docs, benchmark, work).drop("n_words")
