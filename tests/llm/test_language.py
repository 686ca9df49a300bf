from __future__ import annotations

import zlib

import numpy as np
import pytest

from basketry.llm import language as g


def test_held_out_accuracy(docs, work):
    got = g.op10_language(docs, work).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got) and len(got) > 30
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(odd_docs, odd_rows, work):
    got = g.op10_language(odd_docs, work).collect()
    assert len(got) == len(odd_rows)
    letters = {str(i): False for i, _ in odd_rows}
    for i, t in odd_rows:
        letters[str(i)] |= any(map(str.isalpha, t or ""))
    assert {r.lang_pred for r in got} == {"en", g.UNKNOWN}
    assert all(letters[str(r.doc_id)] for r in got if r.lang_pred == "en")
    lost = [t for _, t in odd_rows if not any(map(str.isalpha, t or ""))]
    assert sum(r.lang_pred == g.UNKNOWN for r in got) == len(lost)
    assert all(r.score == 0 for r in got if r.lang_pred == g.UNKNOWN)


def test_nothing_to_learn_from(spark, no_docs, work):
    schema = "doc_id long, text string, lang string"
    got = g.op10_language(spark.createDataFrame([(1, "text", None), (2, None, "en")], schema), work).collect()
    assert {(r.lang_pred, r.score) for r in got} == {(g.UNKNOWN, 0.0)}
    assert g.op10_language(no_docs, work).count() == 0


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "fr") for i in range(900)]
    got = g.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 40).collect()
    by = {lang: [r for r in got if r.lang == lang] for lang in ("en", "fr")}
    assert all(30 < len(v) <= 40 for v in by.values())
    assert all(zlib.crc32(r.text.split()[1].encode()) % 4 != 2 for r in got)


def brute(rows, block=None):
    """lang_pred and score of each text by counting n-grams one by one, over all languages at once."""
    learned = [(t, lang) for i, t, lang in rows if lang is not None and t is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    names = sorted({lang for _, lang in learned})
    counts = np.full((1 << g.WIDTH, len(names)), g.SMOOTHING)
    for t, lang in learned:
        for _, feature, _ in g.hashed([t], g.SIZES, g.WIDTH):
            np.add.at(counts[:, names.index(lang)], feature, 1)
    log_prob = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    prior = np.log(np.array([sum(of == x for _, of in learned) for x in names]) / len(learned))
    out = {}
    for i, t, _ in rows:
        total = prior + sum(log_prob[f].sum(axis=0, dtype=np.float64) for _, f, _ in g.hashed([t], g.SIZES, g.WIDTH))
        chance = np.exp(total - total.max())
        letters = t is not None and any(map(str.isalpha, t))
        out[i] = (names[int(total.argmax())], chance.max() / chance.sum()) if letters else (g.UNKNOWN, 0.0)
    return out


@pytest.mark.parametrize("block", [g.BLOCK, 7, 1])
def test_equals_brute_force_for_any_number_of_languages(spark, work, block):
    """More languages than a block holds, some with a single document; every one is learned and told apart."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        words = ["".join(rng.choice(list(f"{chr(97 + k % 26)}{chr(97 + k // 26)}xyz"), 5)) for _ in range(40)]
        rows += [(len(rows) + j, " ".join(rng.permutation(words)), f"l{k:03d}" if j < 6 else None) for j in range(7)]
    rows += [(len(rows), None, None), (len(rows) + 1, "123", "l001")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = g.fit(frame, work)
    assert len(model.languages) == 300
    got = {r.doc_id: (r.lang_pred, r.score) for r in g.identify(frame, model, block).collect()}
    want = brute(rows)
    assert {i: x[0] for i, x in got.items()} == {i: x[0] for i, x in want.items()}
    assert all(got[i][1] == pytest.approx(want[i][1], abs=1e-5) for i in want)
    assert sum(got[i][0] == f"l{i // 7:03d}" for i in range(6, 2100, 7)) > 290
