from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from basketry.llm import token_counts as t
from basketry.llm.bpe import share_file

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words():
    with open(PATH, "rb") as file:
        return t.vocabulary(file.read())


def brute(word, scores):
    """Best segmentation of one pre-token, by itself: score, tokens, pieces. Equal ones: the longest last piece."""
    unknown = min(scores.values()) - t.UNKNOWN_PENALTY
    best = [(0, 0, ())]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(max(0, end - 64), end):
            piece = word[start:end]
            if piece in scores:
                options.append((best[start][0] + scores[piece], -start, best[start][1] + 1, (*best[start][2], piece)))
            elif end == start + 1:
                options.append((best[start][0] + unknown, -start, best[start][1] + len(piece.encode()), best[start][2]))
        score, _, n, pieces = max(options, key=lambda o: o[:2])
        best.append((score, n, pieces))
    return best[-1]


def brute_scores(corpus, words, rounds=t.ROUNDS):
    """The estimated scores, from each occurrence of each word by itself."""
    scores = dict(zip(words.pieces, t.first_scores(len(words.pieces)), strict=True))
    number = {piece: n for n, piece in enumerate(words.pieces)}
    occurrences = Counter(w for text in corpus for w in (text or "").split())
    for _ in range(rounds):
        used = Counter()
        for w, n in occurrences.items():
            for piece in brute(t.SPACE_MARK + w, scores)[2]:
                used[number[piece]] += n
        scores = dict(zip(words.pieces, t.estimated(used, len(words.pieces)), strict=True))
    return scores


def library(words, scores):
    """The same vocabulary and scores in a library that segments each word by itself."""
    least = min(scores) / t.UNIT
    own = [(p, s / t.UNIT) for p, s in zip(words.pieces, scores, strict=True)]
    made = Tokenizer(models.Unigram([("<unk>", least), *own, *((f"<0x{b:02X}>", least) for b in range(256))], unk_id=0, byte_fallback=True))
    split = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")]
    made.pre_tokenizer = pre_tokenizers.Sequence(split)
    return made


WORDS = ["▁the", "▁then", "▁there", "▁therein", "▁", "▁漢字", "▁thonbleanren", "▁thonble", "▁aaaaaa", "▁aaaa", "é"]


@pytest.mark.parametrize("order", [sorted, list])
def test_shared_starts_give_what_each_word_gives_alone(words, order):
    """Scores, tokens and used pieces, in the trie's order or any other, repeated words too."""
    first = t.first_scores(len(words.pieces))
    scores = dict(zip(words.pieces, first, strict=True))
    trie, used = t.Trie(words, first), Counter()
    for n, w in enumerate(order([*WORDS, "▁the", "▁the"]), 1):
        score, tokens, pieces = brute(w, scores)
        assert trie.add(w, n) == (tokens, score)
        used.update({words.pieces.index(p): n * k for p, k in Counter(pieces).items()})
    assert trie.finish() == used
    if order is sorted:
        assert trie.nodes < sum(map(len, WORDS))


@pytest.fixture(scope="module")
def learned(spark, docs, words):
    from basketry.scratch import Scratch

    work = Scratch(spark)
    yield t.learn(t.pretokens(docs, work), share_file(spark, PATH))
    work.close()


def test_shares_are_estimated_from_every_occurrence(pairs, words, learned):
    assert dict(zip(words.pieces, learned, strict=True)) == brute_scores([x for _, x in pairs], words)


def test_pretokens_are_counted_over_all_texts(odd_docs, odd_rows, work):
    want = Counter(w for _, x in odd_rows for w in (x or "").split())
    got = [(r.word, r.n) for r in t.pretokens(odd_docs, work).collect()]
    assert dict(got) == want and len(got) == len(want)


def test_counts_equal_the_library(docs, pairs, words, learned, work):
    got = {r.doc_id: r for r in t.op3_token_counts(docs, work).collect()}
    want = library(words, learned).encode_batch([x or "" for _, x in pairs])
    assert len(got) == len(pairs)
    for (i, text), encoding in zip(pairs, want, strict=True):
        assert got[i].n_tokens == len(encoding.ids)
        assert got[i].n_pretokens == len((text or "").split())


@pytest.mark.parametrize("most", [t.FREQUENT, 5, 0])
def test_odd_rows_equal_brute_force(odd_docs, odd_rows, words, work, most):
    """However many words are broadcast, the same; a word over the longest key is joined by its digest."""
    scores = brute_scores([x for _, x in odd_rows], words)
    alone = {w: brute(t.SPACE_MARK + w, scores) for w in {w for _, x in odd_rows for w in (x or "").split()}}
    want = []
    for i, x in odd_rows:
        own = [alone[w] for w in (x or "").split()]
        want.append((str(i), len(own), sum(o[1] for o in own), sum(o[0] for o in own) / t.UNIT))
    rows = t.count_tokens(odd_docs, PATH, work, most=most).collect()
    assert sorted((str(r.doc_id), r.n_pretokens, r.n_tokens, r.log_prob) for r in rows) == sorted(want)


def test_long_words_and_division_of_rows(spark, work, words):
    """One word of 450,000 characters, long words that repeat; one task or many."""
    long = "ab" * 225_000
    rows = [(1, long), (2, f"x {'é' * 60} y"), (3, "é" * 60), (4, f"{'é' * 60} {long} z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(t.count_tokens(frame.coalesce(1), PATH, work, rounds=1, most=1).collect())
    assert one == sorted(t.count_tokens(frame.repartition(4), PATH, work, rounds=1).collect())
    by = {r.doc_id: r for r in one}
    assert by[4].n_tokens == by[1].n_tokens + by[3].n_tokens + 1
    assert [by[i].n_pretokens for i in (1, 2, 3, 4)] == [1, 3, 1, 3]


def test_frequent_words_are_whole_bands_within_the_bound(spark):
    frame = spark.createDataFrame([(int(n),) for n in np.random.default_rng(1).zipf(1.5, 3000).clip(1, 10**9)], "n long")
    total = sorted((r.n for r in frame.collect()), reverse=True)
    for most in (0, 1, 10, 100, 3000):
        got = sorted((r.n for r in frame.where(t.frequent(frame, most)).collect()), reverse=True)
        assert len(got) <= most and got == total[: len(got)]
    assert len(got) == 3000


def test_no_rows(no_docs, work):
    assert t.op3_token_counts(no_docs, work).count() == 0


def test_blank_text_has_no_token(spark, work):
    row = t.op3_token_counts(spark.createDataFrame([(1, " \n")], "doc_id long, text string"), work).first()
    assert (row.n_pretokens, row.n_tokens, row.log_prob) == (0, 0, 0.0)
