from __future__ import annotations

import pytest

CLASHING = (
    "score predicted lang_pred kept keep_id group_size tag part shard slot virtual_slot size length start print root signature "
    "row node _id _hash _key _word _bits _maybe ids n once whole survives text_hash component_id"
).split()

LONG = "thonble anren " * 40_000
TEXTS = [
    "The cat sat on the mat and looked at the moon for a while.",
    "the CAT sat on the mat and looked at the moon for a while.",
    "The cat sat on the mat and looked at the moon for a while.",
    "",
    None,
    None,
    " \t\n ",
    "12345 67890 !!",
    "é",
    "É",
    "Straße und Größe, schön über alles; der Hund läuft schnell.",
    "\U0001f600 漢字 仮名 x y",
    LONG,
    LONG + "x",
    "one two",
    "a",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, repeated and null ids."""
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(0, TEXTS[0]), (0, TEXTS[0]), (None, TEXTS[0]), (None, None), (3, "another text under a used id"), (-7, TEXTS[10])]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows as documents, with extra columns whose names operators use themselves."""
    rest = ("x",) * len(CLASHING)
    rows = [(i, t, "en" if n % 2 else None, None, None, *rest) for n, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def work(spark):
    from basketry.scratch import Scratch

    made = Scratch(spark)
    yield made
    made.close()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
