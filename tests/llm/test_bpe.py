from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from basketry.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def oracle():
    with open(PATH, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_on_awkward_texts(codec, oracle):
    parts = [" ", "  ", "\n", "\t", " ", " ", "　", "\x1c", "\x1f", "\x85", "a", "A", "é", "ß", "1", "²", "'s", "'", "!"]
    parts += ["--", "==", "....", "the", "ing", "\U0001f600", "漢", "́", "_", "aaaa", "    ", "<|endoftext|>", "Ж", "ا"]
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += [part * n for part in (" ", "a", "=", "aa", "ab", "\n", "é", "!?") for n in range(1, 90)]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype=bpe.ID).tolist() == oracle.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def check(rows, texts, oracle):
    want = []
    for i, t in texts:
        ids = np.array(oracle.encode_ordinary(t or ""), dtype=bpe.ID)
        want.append((str(i), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(want)


def test_round_trip(docs, pairs, oracle):
    check(bpe.op2_byte_bpe(docs).collect(), pairs, oracle)


def test_odd_rows(odd_docs, odd_rows, oracle):
    check(bpe.op2_byte_bpe(odd_docs).collect(), odd_rows, oracle)


def test_no_rows(no_docs):
    assert bpe.op2_byte_bpe(no_docs).count() == 0


def test_spans_and_split_characters(spark):
    text = "漢字é \U0001f600x the"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    row, empty = sorted(encoded.collect(), key=lambda r: r.doc_id)
    assert empty.ids == [] and empty.first_char == []
    assert row.first_char[0] == 0 and row.end_char[-1] == len(text)
    assert all(a <= b for a, b in zip(row.first_char, row.first_char[1:], strict=False))
    back = {r.doc_id: r for r in bpe.decode(encoded, PATH, public_tokenizers.PATTERN).collect()}
    assert back[1].text == text and back[2].text == "" and bytes(back[1].bytes) == text.encode()
    cut = bpe.decode(encoded.withColumn("ids", F.slice("ids", 1, 1)), PATH, public_tokenizers.PATTERN).where("doc_id = 1").first()
    assert text.encode().startswith(bytes(cut.bytes)) and cut.text in ("漢", "�")


def test_memory_of_pieces_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    codec.encode.known.clear()
    for n in range(5):
        codec.encode([" ".join(f"w{n}x{k}" for k in range(8))])
    assert len(codec.encode.known) <= 18
