"""Token counts under a unigram model of the corpus, by dynamic programming that pre-tokens with a common start share."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.bpe import share_file
from basketry.llm.common import texts
from basketry.llm.ngrams import segments, slices
from basketry.scratch import Scratch

SPACE_MARK = "▁"
# Log-probabilities are whole multiples of a millionth: their sums are exact, so results don't depend on the order of rows.
UNIT = 1_000_000
# A character that no piece holds costs this much more than the rarest piece, and a token for each of its bytes.
UNKNOWN_PENALTY = 10 * UNIT
# The shares of the pieces are estimated from all distinct pre-tokens so many times.
ROUNDS = 2
# A task counts words until it holds so many different ones, then hands them on.
COUNTED_AT_ONCE = 200_000
# The counts of so many pre-tokens at most, the most frequent ones, are broadcast.
FREQUENT = 300_000
# Bands of frequency: a band's words are at most a twelfth or so more frequent than its rarest.
BANDS = 8
# A longer pre-token goes by its digest where counts are joined, so a key's size is bounded.
LONGEST_KEY = 48


@dataclass(frozen=True)
class Vocabulary:
    """The pieces, and the automaton that reads them: state 0 is the start, ``own`` the piece a state completes or -1."""

    pieces: list[str]
    step: list[dict[str, int]]
    own: list[int]


def read(pieces: list[str]) -> Vocabulary:
    step: list[dict[str, int]] = [{}]
    own = [-1]
    for number, piece in enumerate(pieces):
        state = 0
        for char in piece:
            if char not in step[state]:
                step[state][char] = len(step)
                step.append({})
                own.append(-1)
            state = step[state][char]
        own[state] = number
    return Vocabulary(pieces, step, own)


@lru_cache(maxsize=4)
def vocabulary(content: bytes) -> Vocabulary:
    """The ordinary pieces of a sentencepiece model in the order of their ids, read once in each process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    ids = range(model.get_piece_size())
    return read([model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))])


def first_scores(size: int) -> list[int]:
    """Where the estimation starts: the n-th piece of the vocabulary has a share in proportion to 1 / n."""
    norm = math.log(sum(1 / n for n in range(1, size + 1))) if size else 0.0
    return [round(UNIT * (-math.log(n) - norm)) for n in range(1, size + 1)]


def estimated(used: dict[int, int], size: int) -> list[int]:
    """Scores of the pieces from how often each was used; one more each, so that none is impossible."""
    total = sum(used.values()) + size
    return [round(UNIT * math.log((used.get(n, 0) + 1) / total)) for n in range(size)]


class Trie:
    """Segments pre-tokens; the forward scores of a common start are computed once.

    In order, pre-tokens come in the depth-first order of their trie. So only the path to the current
    one is kept: it is cut back to the start that the next one shares, and grows from there. Any other
    order gives the same results with less to share. A node's weight is the number of occurrences whose
    best segmentation passes it; when a node is cut off, its weight goes to the piece that ends there and
    on to the node where this piece starts, so the pieces of a shared start are counted once as well.
    """

    def __init__(self, words: Vocabulary, scores: list[int]):
        self.step, self.own, self.scores = words.step, words.own, scores
        self.unknown = min(scores, default=0) - UNKNOWN_PENALTY
        self.used: Counter[int] = Counter()
        self.nodes = 0
        self.word = ""
        # By node; node i stands for the first i characters. Forward score, tokens, starts from which a piece
        # may go on with the state it is in, the last piece (-1: none), where that starts, and the weight.
        self.best, self.tokens, self.live = [0], [0], [()]
        self.piece, self.came, self.weight = [-1], [0], [0]

    def add(self, word: str, n: int = 1) -> tuple[int, int]:
        """Tokens and score of the best segmentation of a pre-token that occurs ``n`` times.

        Of equally good segmentations the one with the longest last piece counts.
        """
        shared = 0
        for a, b in zip(self.word, word):  # noqa: B905
            if a != b:
                break
            shared += 1
        self._cut(shared)
        for char in word[shared:]:
            self._extend(char)
        self.word = word
        self.weight[-1] += n
        return self.tokens[-1], self.best[-1]

    def finish(self) -> Counter[int]:
        """How often each piece was used."""
        self._cut(0)
        self.word = ""
        return self.used

    def _cut(self, depth: int) -> None:
        for node in range(len(self.best) - 1, depth, -1):
            if n := self.weight[node]:
                self.weight[self.came[node]] += n
                if self.piece[node] >= 0:
                    self.used[self.piece[node]] += n
        for held in (self.best, self.tokens, self.live, self.piece, self.came, self.weight):
            del held[depth + 1 :]

    def _extend(self, char: str) -> None:
        self.nodes += 1
        step, own, scores, best = self.step, self.own, self.scores, self.best
        at = len(best) - 1
        alone = step[0].get(char)
        live = []
        score, came, last = -math.inf, at, -1
        for start, state in (*self.live[at], (at, 0)):
            state = step[state].get(char)
            if state is not None:
                live.append((start, state))
                piece = own[state]
                if piece >= 0 and best[start] + scores[piece] > score:
                    score, came, last = best[start] + scores[piece], start, piece
        n = self.tokens[came] + 1
        if (alone is None or own[alone] < 0) and best[at] + self.unknown > score:
            score, came, last = best[at] + self.unknown, at, -1
            n = self.tokens[at] + len(char.encode("utf-8", "replace"))
        best.append(score)
        self.tokens.append(n)
        self.live.append(live)
        self.piece.append(last)
        self.came.append(came)
        self.weight.append(0)


def key(word: str) -> str:
    """The word, or a digest of a long one; no word is like a digest's key, as that has a space."""
    return word if len(word) <= LONGEST_KEY else " " + hashlib.sha256(word.encode("utf-8", "replace")).hexdigest()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task's texts; a word may come more than once."""
    held: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
        held.clear()
        return made

    for batch in batches:
        for _, part in slices(batch):
            for text in part:
                for piece in segments(text or ""):
                    held.update(piece.split())
                    if len(held) >= COUNTED_AT_ONCE:
                        yield rows()
    yield rows()


def pretokens(docs: DataFrame, work: Scratch) -> DataFrame:
    """(word, n): every distinct pre-token of the texts and how often it occurs, in order by ranges.

    Tasks count before the shuffle, so a frequent word is a row for each task, not for each occurrence.
    """
    counted = docs.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return work.keep(counted.repartitionByRange("word").sortWithinPartitions("word"), "pretokens")


def learn(words: DataFrame, content, rounds: int = ROUNDS) -> list[int]:
    """The score of each piece, from the best segmentations of all pre-tokens (written table ``words``) under the scores before.

    A round scores each distinct pre-token once. The driver gets a number for each piece of the vocabulary.
    """
    size = len(vocabulary(content.value).pieces)
    scores = first_scores(size)
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(scores)

        def use(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie = Trie(vocabulary(content.value), shared.value)
            for batch in batches:
                for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    trie.add(SPACE_MARK + word, n)
            used = trie.finish()
            yield pa.RecordBatch.from_pydict({"piece": pa.array(used.keys(), pa.int32()), "n": pa.array(used.values(), pa.int64())})

        used = words.mapInArrow(use, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        scores = estimated({r.piece: r.n for r in used.collect()}, size)
    return scores


def terminals(words: DataFrame, content, scores: list[int], work: Scratch) -> DataFrame:
    """(key, n, tokens, best): the counts at the end of each distinct pre-token, written."""
    shared = words.sparkSession.sparkContext.broadcast(scores)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(vocabulary(content.value), shared.value)
        for batch in batches:
            own = batch.column("word").to_pylist()
            found = [trie.add(SPACE_MARK + word) for word in own]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key(w) for w in own], pa.string()),
                    batch.column("n"),
                    pa.array([tokens for tokens, _ in found], pa.int64()),
                    pa.array([best for _, best in found], pa.int64()),
                ],
                names=["key", "n", "tokens", "best"],
            )

    return work.keep(words.mapInArrow(score, "key string, n long, tokens long, best long"), "terminals")


def frequent(counted: DataFrame, most: int = FREQUENT) -> Column:
    """Which rows of ``counted`` are the most frequent: whole bands of frequency, ``most`` rows at most."""
    band = F.floor(F.log2("n") * BANDS)
    sizes = sorted(counted.groupBy(band.alias("band")).count().collect(), reverse=True)
    lowest, held = math.inf, 0
    for row in sizes:
        held += row["count"]
        if held > most:
            break
        lowest = row.band
    return band >= F.lit(float(lowest))


@dataclass
class Known:
    """The counts of the frequent pre-tokens; the last place stands for any other word and adds nothing."""

    place: dict[str, int]
    tokens: np.ndarray
    best: np.ndarray

    def look_up(self, words: Iterable[str], n: int) -> np.ndarray:
        return np.fromiter(map(self.place.get, words, repeat(len(self.place))), dtype=np.int64, count=n)


_known: list[tuple[tuple, Known]] = []


def known(value: tuple) -> Known:
    """The table of a broadcast (keys, tokens, best), put together once in each process."""
    if not _known or _known[0][0] is not value:
        keys, tokens, best = value
        _known[:] = [(value, Known({k: i for i, k in enumerate(keys)}, np.append(tokens, 0), np.append(best, 0)))]
    return _known[0][1]


PARTS = pa.schema(
    [
        ("tag", pa.int64()), ("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("best", pa.int64()),
        ("rare", pa.list_(pa.string())),
    ]
)


def sum_known(docs: DataFrame, counts: DataFrame, work: Scratch) -> DataFrame:
    """What the frequent pre-tokens add to each document, and the keys of its others; a very long text gives several rows."""
    held = counts.select("key", "tokens", "best").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        (held.column("key").to_pylist(), held.column("tokens").to_numpy(), held.column("best").to_numpy())
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known(shared.value)
        for batch in batches:
            for start, part in slices(batch):
                owner, words = [], []
                for row, text in enumerate(part, start):
                    for piece in segments(text or ""):
                        owner.append(row)
                        words.append(piece.split())
                    if len(part) == 1:  # a single text may be very long: one row for each of its segments
                        for one in words[:-1]:
                            yield _sums(batch, [row], [one], table)
                        owner, words = owner[-1:], words[-1:]
                yield _sums(batch, owner, words, table)

    tagged = docs.withColumn("tag", F.monotonically_increasing_id())
    schema = "tag long, doc_id long, n_pretokens long, n_tokens long, best long, rare array<string>"
    return work.keep(tagged.mapInArrow(add, schema), "parts")


def _sums(batch: pa.RecordBatch, owner: list[int], words: list[list[str]], table: Known) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    keys = [key(w) if len(w) > LONGEST_KEY else w for own in words for w in own]
    place = table.look_up(keys, len(keys))
    others = np.flatnonzero(place == len(table.place))
    ends = np.searchsorted(others, np.cumsum(sizes))
    rare = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array([keys[i] for i in others.tolist()], pa.string())
    )
    rows = pa.array(owner, pa.int64())
    sums = [exact_sums(values[place], sizes) for values in (table.tokens, table.best)]
    columns = [batch.column("tag").take(rows), batch.column("doc_id").take(rows), pa.array(sizes), *map(pa.array, sums), rare]
    return pa.RecordBatch.from_arrays(columns, schema=PARTS)


def exact_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``sizes`` whole numbers."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def count_tokens(
    docs: DataFrame, model_path: str, work: Scratch, rounds: int = ROUNDS, most: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_pretokens, n_tokens and log_prob of every whole text, under a unigram model of all texts.

    Pre-tokens are what stands between white space, each marked at its start; a token is a piece of
    the vocabulary, or a byte of a character that no piece holds. The pieces' shares are estimated from the
    corpus: ``rounds`` times all distinct pre-tokens are segmented as well as can be, and a piece's share is
    how often it was used (plus one) in all occurrences. Then each distinct pre-token is scored once more and
    its count stored.

    The counts of the ``most`` frequent pre-tokens are broadcast and summed where the texts are; the others,
    none of them frequent, are joined by a shuffle. Log-probabilities are sums of millionths, so they are the same
    for any order and division of the rows.

    A null, empty or blank text has no token and log_prob 0. Very long texts are counted whole, in parts.
    Ids may be null or repeat; every row gives a row and repeated rows count as often as they come. An
    empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col)
    content = share_file(docs.sparkSession, model_path)
    words = pretokens(rows, work)
    counts = terminals(words, content, learn(words, content, rounds), work)
    often = frequent(counts, most)
    parts = sum_known(rows, counts.where(often), work)
    rare = parts.select("tag", F.explode("rare").alias("key")).join(counts.where(~often).drop("n"), "key")
    zero = F.lit(0).cast("long")
    added = rare.select(
        "tag",
        F.lit(None).cast("long").alias("doc_id"),
        zero.alias("n_pretokens"),
        F.col("tokens").alias("n_tokens"),
        "best",
    )
    summed = parts.drop("rare").unionByName(added).groupBy("tag")
    names = ["n_pretokens", "n_tokens", "best"]
    found = summed.agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in names])
    return found.select("doc_id", "n_pretokens", "n_tokens", (F.col("best") / F.lit(float(UNIT))).alias("log_prob"))


def op3_token_counts(docs: DataFrame, work: Scratch) -> DataFrame:
    import public_tokenizers

    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), work)
