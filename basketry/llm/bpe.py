"""Byte-level BPE: text to ids and back, with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from basketry.llm.common import append_columns, texts
from basketry.llm.ngrams import SLICE_CHARS, segments

# The characters with the property White_Space, which \s matches in the tokenizers' patterns.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# No token spans a border between another character and white space, so texts can be cut there.
BEFORE_SPACE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

# Cut pieces come again and again; the ids of so many are remembered by a worker process, if short.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 48
ENCODED_AT_ONCE = 20_000
ID = np.dtype("<u4")
FOUR_BYTES = next(code for code in "IL" if array(code).itemsize == ID.itemsize)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """The tokens of a rank file: a base64 token and its id on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def build(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizer that merges within each match of ``pattern``: always the neighbours that form the lowest token."""
    shown = byte_characters()
    spelled = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (spelled[token[:cut]], spelled[token[cut:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    tokenizer = Tokenizer(models.BPE({spelled[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


class Encoder:
    """Ids of whole texts, by pieces whose ids are remembered in this process up to a bound."""

    def __init__(self, tokenizer: Tokenizer, cut: Callable[[str], list[str]]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        self.tokenizer, self.cut = tokenizer, cut
        self.known: dict[str, bytes] = {}

    def _encoded(self, pieces: Iterable[str]) -> dict[str, bytes]:
        pieces = list(pieces)
        found = {}
        for at in range(0, len(pieces), ENCODED_AT_ONCE):
            part = pieces[at : at + ENCODED_AT_ONCE]
            encodings = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            found.update((p, array(FOUR_BYTES, e.ids).tobytes()) for p, e in zip(part, encodings, strict=True))
        return found

    def __call__(self, batch: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if any(len(t) > 2 * SLICE_CHARS for t in batch):
            return [b"".join(self._ids([part])[0] for part in segments(t)) for t in batch]
        return self._ids(batch)

    def _ids(self, batch: list[str]) -> list[bytes]:
        out = []
        cut = [self.cut(t) for t in batch]
        looked_up = [list(map(self.known.get, pieces)) for pieces in cut]
        fresh = self._encoded({p for pieces, got in zip(cut, looked_up, strict=True) for p, g in zip(pieces, got, strict=True) if g is None})
        for pieces, got in zip(cut, looked_up, strict=True):
            if None in got:
                got = [fresh[p] if g is None else g for p, g in zip(pieces, got, strict=True)]
            out.append(b"".join(got))
        if len(self.known) < REMEMBERED:
            self.known.update((p, i) for p, i in fresh.items() if len(p) <= LONGEST_REMEMBERED)
        return out


class Codec:
    """Both directions for one rank file, in one process."""

    def __init__(self, content: bytes, pattern: str):
        ranks = parse_ranks(content)
        self.encode = Encoder(build(ranks, pattern), BEFORE_SPACE.findall)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.width = np.array([len(t) for t in self.token], dtype=np.int64)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype=ID).tolist()))

    def spans(self, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last; a character split over tokens belongs to each."""
        ends = np.cumsum(self.width[np.frombuffer(ids, dtype=ID)])
        if not len(ends):
            return ends, ends
        starts = ends - self.width[np.frombuffer(ids, dtype=ID)]
        lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        character = np.cumsum(lead) - 1
        return character[starts], character[ends - 1] + 1


_codecs: dict[tuple[int, str], Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """The codec of a rank file, built once in each process."""
    key = (hash(content), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(content, pattern)
    return _codecs[key]


def share_file(spark: SparkSession, path: str):
    """A vocabulary file (a megabyte or two) for all executors: only the driver needs to see the path."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def utf8(text: str | None) -> str:
    return text or ""


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, first_char and end_char (a span of characters for each id) of every text.

    Whole texts, without special tokens; the strings of special tokens are ordinary text. A null text
    counts as empty and has no ids. Ids of documents may be null or repeat; every row gives a row.
    """
    content = share_file(docs.sparkSession, ranks_path)

    def columns(batch: list[str | None]) -> dict[str, list]:
        own = codec(content.value, pattern)
        plain = [utf8(t) for t in batch]
        ids = own.encode(plain)
        spans = [own.spans(i, t.encode()) for i, t in zip(ids, plain, strict=True)]
        return {
            "ids": [np.frombuffer(i, dtype=ID).astype(np.int32) for i in ids],
            "first_char": [s.astype(np.int32) for s, _ in spans],
            "end_char": [e.astype(np.int32) for _, e in spans],
        }

    schema = "ids array<int>, first_char array<int>, end_char array<int>"
    return append_columns(texts(docs, id_col, text_col), columns, schema, drop_text=True)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, bytes and text of lists of ids, through the table of bytes.

    A list may begin or end within a character: ``bytes`` has exactly what the ids stand for, ``text``
    the replacement character there. Null lists count as empty; an unknown id raises.
    """
    content = share_file(encoded.sparkSession, ranks_path)
    joined = F.concat_ws(",", F.col(ids_col).cast("array<string>")).alias("text")

    def columns(batch: list[str | None]) -> dict[str, list]:
        own = codec(content.value, pattern)
        data = [own.decode(np.array([int(i) for i in t.split(",")] if t else [], dtype=ID).tobytes()) for t in batch]
        return {"bytes": data, "decoded": [d.decode("utf-8", "replace") for d in data]}

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), joined)
    made = append_columns(rows, columns, "bytes binary, decoded string", drop_text=True)
    return made.withColumnRenamed("decoded", "text")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, without moving either.

    Whole texts, without special tokens; very long ones are cut where no token can cross. A null text
    counts as empty: no token, and the digests of nothing. Ids of documents may be null or repeat; every
    row gives a row, an empty table none.
    """
    content = share_file(docs.sparkSession, ranks_path)

    def columns(batch: list[str | None]) -> dict[str, list]:
        own = codec(content.value, pattern)
        ids = own.encode([utf8(t) for t in batch])
        return {
            "n_tokens": [len(i) // ID.itemsize for i in ids],
            "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
            "decoded_sha256": [hashlib.sha256(own.decode(i)).hexdigest() for i in ids],
        }

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return append_columns(texts(docs), columns, schema, drop_text=True)


def op2_byte_bpe(docs: DataFrame, _work=None) -> DataFrame:
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
