from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from basketry.llm import alignment as al
from basketry.llm.bpe import byte_characters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def ends(parts):
    return np.cumsum([len(x) for x in parts]).tolist()


def brute_text(text, tokenizers):
    """(a ids, b ids, groups, linked id pairs) of a whole text at once; None without tokens."""
    if not text:
        return None
    first, second = tokenizers
    code = {c: b for b, c in enumerate(byte_characters())}
    data = (" " + text).encode()
    encoded = first.encode(" " + text, add_special_tokens=False)
    a = [bytes(code[c] for c in token) for token in encoded.tokens]
    ids = second.encode(text)
    b = []
    for i in ids:
        piece = second.id_to_piece(i)
        b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
    if b"".join(a) != data or b"".join(b) != data:
        return None
    end_a, end_b = ends(a), ends(b)
    links = []
    j = 0
    for i, end in enumerate(end_a):
        start = end - len(a[i])
        while end_b[j] <= start:
            j += 1
        k = j
        while k < len(b) and end_b[k] - len(b[k]) < end:
            links.append((encoded.ids[i], ids[k]))
            k += 1
    groups, i, j = [], 0, 0
    for cut in sorted(set(end_a) & set(end_b)):
        to_i, to_j = end_a.index(cut, i) + 1, end_b.index(cut, j) + 1
        groups.append(",".join(map(str, encoded.ids[i:to_i])) + "|" + ",".join(map(str, ids[j:to_j])))
        i, j = to_i, to_j
    return encoded.ids, ids, groups, links


def brute(rows, tokenizers):
    known = {}
    for _, t in rows:
        if t not in known:
            known[t] = brute_text(t, tokenizers)
    counts = Counter()
    for _, t in rows:
        counts.update(known[t][3] if known[t] else ())
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = Counter()
    for i, t in rows:
        if known[t] is None:
            out[(i, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        a, b, groups, links = known[t]
        best = sum(counts[x] == highest[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out[(i, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), digest)] += 1
    return out, counts


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df):
    assert df.columns == COLUMNS and [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return Counter(tuple(r) for r in df.collect())


def test_equals_brute_force(docs, pairs, tokenizers, work):
    assert found(al.op11_alignment(docs, work)) == brute(pairs, tokenizers)[0]


def test_odd_rows(odd_docs, odd_rows, tokenizers, work):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 100_000]
    short = odd_docs.where("text is null or length(text) < 100000")
    documents, counts = al.align(short, work, A, B)
    want, pairs = brute(rows, tokenizers)
    assert found(documents) == want
    assert Counter({(r.a, r.b): r["count"] for r in counts.collect()}) == pairs


def test_every_odd_row_gives_a_row(odd_docs, odd_rows, work):
    got = al.op11_alignment(odd_docs, work).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd_rows)
    assert max(r.n_a for r in got) > 80_000


def test_no_rows(no_docs, work):
    assert al.op11_alignment(no_docs, work).count() == 0
    assert all(d.count() == 0 for d in al.align(no_docs, work, A, B))


def random_texts(n):
    parts = [" ", "  ", "\n", "\r", "\t", "　", " ", "\x1c", "\x00", "a", "B", "É", "ß", "1", "22", "it's", "!?", "the", "Ing", ";", "}"]
    parts += ["\U0001f600", "漢字", "́", "▁", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "<unk>", "word", " the", "(){", "İ", "ﬁ", "​"]
    rnd = random.Random(12)
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_chunks_give_what_the_whole_text_gives(tokenizers):
    align = al.Aligner(open(A, "rb").read(), open(B, "rb").read())  # noqa: SIM115
    texts = ["foo ", " ", "  ", " \n", "a  b", *random_texts(4000)]
    for text, (n_a, n_b, n_groups, n_links, digest, keys) in zip(texts, align(texts), strict=True):
        want = brute_text(text, tokenizers)
        if want is None:
            assert (n_a, n_b, n_groups, n_links, digest, len(keys)) == (0, 0, 0, 0, "", 0), repr(text)
            continue
        a, b, groups, links = want
        assert (n_a, n_b, n_groups, n_links) == (len(a), len(b), len(groups), len(links)), repr(text)
        assert digest == hashlib.sha256(";".join(groups).encode()).hexdigest()
        assert sorted((int(k) & al.LOW, int(k) >> al.SIDE) for k in keys) == sorted(links)


@pytest.mark.parametrize("fan_in", [2, 64])
def test_many_runs_are_merged_in_rounds(spark, tokenizers, work, monkeypatch, fan_in):
    """More runs than are merged or counted back at once; one pair is in most documents."""
    monkeypatch.setattr(al, "FAN_IN", fan_in)
    monkeypatch.setattr(al, "RUNS_AT_ONCE", 3)
    rows = [(i, "the" if i % 3 else t) for i, t in enumerate(random_texts(600))]
    documents, counts = al.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), work, A, B)
    want, pairs = brute(rows, tokenizers)
    assert found(documents) == want
    assert Counter({(r.a, r.b): r["count"] for r in counts.collect()}) == pairs


def test_runs_are_squeezed_and_read_in_frames(monkeypatch):
    monkeypatch.setattr(al, "FRAME", 10)
    rng = np.random.default_rng(1)
    runs = [np.unique(rng.integers(0, 60, 40)) for _ in range(5)]
    data = [al.squeeze(k, np.arange(1, len(k) + 1)) for k in runs]
    assert [al.whole(d, 2)[0].tolist() for d in data] == [k.tolist() for k in runs]
    want = Counter()
    for k in runs:
        want.update(dict(zip(k.tolist(), range(1, len(k) + 1), strict=True)))
    got = [np.concatenate(x) for x in zip(*al.merged(data), strict=True)]
    assert got[0].tolist() == sorted(want) and dict(zip(*map(np.ndarray.tolist, got), strict=True)) == want
    assert al.whole(b"", 3)[0].tolist() == []


def test_a_run_ends_at_its_bound():
    run = al.Run(7)
    for k in range(3):
        assert run.add(np.array([5 << al.SIDE | k, 5 << al.SIDE | k, 70 << al.SIDE], dtype=np.int64)) == k
    assert (run.records, run.documents) == (6, 3)
    rows = run.rows().to_pylist()
    assert [r["part"] for r in rows] == [5, 6]
    assert [x.tolist() for x in al.whole(rows[1]["records"], 3)] == [[70 << al.SIDE] * 3, [0, 1, 2], [1, 1, 1]]
    assert al.Run(0).rows().num_rows == 0
