from __future__ import annotations

import re

import pytest

from basketry.llm import licenses as c


def brute(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data)
    places, labels = [], set()
    for phrase, label in c.BASE.items():
        own = phrase.encode().split()
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(got, rows):
    want = sorted((str(i), *map(str, brute(t))) for i, t in rows)
    assert sorted((str(r.doc_id), *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


AWKWARD = [
    "MIT License MIT license mit LICENSE",
    "mit-license, apache\nlicense; CC BY cc by",
    "emit license, mit licenses, éapache license",
    "GNU General\tPublic License gnu general public gnu general public license",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\ntext",
    "spdx-license-identifier: MIT OR\nspdx-license-identifier: (mit",
    "SPDX-License-Identifier:",
    "mit license " * 3000,
]


def test_equals_brute_force(docs, pairs):
    check(c.op9_licenses(docs).collect(), pairs)


def test_awkward_texts(spark):
    rows = list(enumerate(AWKWARD))
    got = c.op9_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, rows)
    by = {r.doc_id: r for r in got}
    assert by[4].labels == "apache,apache-2.0,gpl,gpl-2.0-only,mit" and by[4].permissive is False
    assert by[5].expressions == ["mit"] and by[6].expressions == [] and by[6].permissive is None


def test_odd_rows(odd_docs, odd_rows):
    check(c.op9_licenses(odd_docs).collect(), odd_rows)


def test_no_rows(no_docs):
    assert c.op9_licenses(no_docs).count() == 0


@pytest.mark.parametrize(
    "text, permissive",
    [
        ("mit", True),
        ("gpl-3.0", False),
        ("mit or gpl-3.0", True),
        ("mit and gpl-3.0", False),
        ("mit or gpl-3.0 and gpl-2.0", True),
        ("(mit or gpl-3.0) and gpl-2.0", False),
        ("gpl-2.0 with classpath-exception-2.0 or mit", True),
        ("apache-2.0 with llvm-exception and bsd-3-clause", True),
        ("unheard-of", False),
    ],
)
def test_evaluation(text, permissive):
    assert c.evaluate(text).permissive is permissive


@pytest.mark.parametrize("text", ["", "(", ")", "or mit", "(mit", "mit (", "and", "()", "mit)"])
def test_what_is_no_expression(text):
    found = c.evaluate(text)
    assert found is None or found.identifiers == ("mit",)


def test_postfix():
    assert c.to_postfix("a or b and ( c or d ) with e".split()) == "a b c d or e with and or".split()


@pytest.mark.parametrize("wrap", ["{}", "({})", "{}\x0b", "Å {}"])
def test_expressions_of_any_length_are_read_whole(wrap):
    names = " OR ".join(["Apache-2.0"] * 300 + ["gpl-3.0-only"] * 300 + ["MIT"])
    text = f"head\nSPDX-License-Identifier: {wrap.format(names) if not wrap.startswith('Å') else names}\r\nmit-0 follows\n"
    found = c.scanner()(("Å" if wrap.startswith("Å") else "") + text)
    assert found["labels"] == "apache,apache-2.0,gpl,gpl-3.0-only,mit"
    assert found["permissive"] is True and found["expressions"][0].count("OR") == 600


def test_a_line_ends_at_a_break_and_not_within_a_character():
    found = c.scanner()("SPDX-License-Identifier: MIT AND Å\nSPDX-License-Identifier: GPL-2.0-only\rMIT AND x")
    assert found["expressions"] == ["mit", "gpl-2.0-only"]
    many = "SPDX-License-Identifier: MIT " * 20_000
    assert len(c.scanner()(many)["expressions"]) == 20_000
