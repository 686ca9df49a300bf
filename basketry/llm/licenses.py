"""License scans: an Aho-Corasick automaton finds notices and tags, a shunting-yard parser reads expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from basketry.llm.common import append_columns, texts

# Phrases every scan looks for, and the labels they stand for.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Longer notices: the phrase, its label, and how sure it makes the scan.
NOTICES = (
    ("gnu general public license version 2", "gpl-2.0", 0.9),
    ("gnu general public license version 3", "gpl-3.0", 0.9),
    ("gnu lesser general public license", "lgpl", 0.9),
    ("gnu affero general public license", "agpl", 0.9),
    ("licensed under the apache license version 2 0", "apache-2.0", 0.95),
    ("released under the mit license", "mit", 0.9),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 0.9),
    ("redistribution and use in source and binary forms", "bsd", 0.9),
    ("bsd 2 clause", "bsd-2-clause", 0.8),
    ("bsd 3 clause", "bsd-3-clause", 0.8),
    ("mozilla public license", "mpl", 0.9),
    ("eclipse public license", "epl", 0.9),
    ("boost software license", "bsl", 0.9),
    ("creative commons attribution", "cc-by", 0.8),
    ("creative commons attribution sharealike", "cc-by-sa", 0.8),
    ("cc by sa", "cc-by-sa", 0.8),
    ("cc by nc", "cc-by-nc", 0.8),
    ("cc0 1 0 universal", "cc0", 0.9),
)
BASE_WEIGHT, TAG_WEIGHT = 0.7, 0.95

TAGS = ("spdx-license-identifier:", "license-expression:")

# Families of identifiers, and whether use asks for no more than a notice.
FAMILIES = {"gpl": False, "lgpl": False, "agpl": False, "mpl": False, "epl": False, "cc-by-sa": False, "cc-by-nc": False}
FAMILIES |= {"apache": True, "mit": True, "bsd": True, "isc": True, "bsl": True, "zlib": True, "cc0": True, "cc-by": True, "unlicense": True}

# A word is a run of digits, a-z and whatever is beyond ASCII; A-Z count as a-z.
WORD_BYTES = bytes(
    b + 32 if ord("A") <= b <= ord("Z") else b if b >= 0x80 or chr(b).isdigit() or ord("a") <= b <= ord("z") else 32 for b in range(256)
)
TOKEN = re.compile(r"[a-z0-9][a-z0-9.+-]*|[()]")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
LINE_END = re.compile(r"[\r\n]")
TAG_WORD = re.compile(b"license", re.IGNORECASE)


@dataclass(frozen=True)
class Expression:
    """A license expression: its identifiers, and whether one may use the work with no more than a notice."""

    text: str
    identifiers: tuple[str, ...]
    permissive: bool


def family(identifier: str) -> str | None:
    """The longest family that an identifier belongs to, version and suffix aside."""
    known = [f for f in FAMILIES if identifier == f or identifier.startswith(f"{f}-") or identifier == f"{f}+"]
    return max(known, key=len, default=None)


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands first, operators by precedence; raises ValueError for what is no expression."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in tokens:
        if token in PRECEDENCE:
            if operand_next:
                raise ValueError(f"{token} without a left side")
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise ValueError("a bracket without an operator")
            held.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("a bracket closes without an operand")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("a bracket too many")
            held.pop()
        else:
            if not operand_next:
                raise ValueError("two operands in a row")
            out.append(token)
            operand_next = False
    if operand_next or "(" in held:
        raise ValueError("ends too early")
    return out + held[::-1]


def evaluate(text: str, at: int = 0, end: int | None = None) -> Expression | None:
    """Read an expression from ``text``, from ``at`` and before ``end``; None if there is none.

    ``a or b`` is permissive if one side is, ``a and b`` if both are, ``a with b`` if a is: the exception
    adds a permission to one license. A text after the expression is ignored.
    """
    tokens: list[str] = []
    end = len(text) if end is None else end
    while True:
        while at < end and text[at] in " \t":
            at += 1
        match = TOKEN.match(text, at, end)
        if not match:
            break
        token = match[0].rstrip(".") if match[0] not in "()" else match[0]
        after_operand = bool(tokens) and tokens[-1] not in PRECEDENCE and tokens[-1] != "("
        if after_operand and token not in PRECEDENCE and token != ")":
            break
        tokens.append(token)
        at = match.end()
    while tokens and tokens[-1] in PRECEDENCE:
        tokens.pop()
    try:
        postfix = to_postfix(tokens)
    except ValueError:
        return None
    stack: list[bool] = []
    names: list[str] = []
    exceptions = {tokens[i + 1] for i, t in enumerate(tokens[:-1]) if t == "with"}
    for token in postfix:
        if token in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append(left or right if token == "or" else left and right if token == "and" else left)
        else:
            stack.append(bool(FAMILIES.get(family(token) or "", False)))
            if token not in exceptions:
                names.append(token)
    return Expression(" ".join(t.upper() if t in PRECEDENCE else t for t in tokens), tuple(sorted(set(names))), stack[0])


def _automaton(words: dict[str, object]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for word, value in words.items():
        made.add_word(word, (len(word), value))
    made.make_automaton()
    return made


class Scanner:
    """The automata of one process."""

    def __init__(self):
        phrases: dict[str, list[tuple[str, float, bool]]] = {}
        for phrase, label in BASE.items():
            phrases.setdefault(f" {phrase} ", []).append((label, BASE_WEIGHT, True))
        for phrase, label, weight in NOTICES:
            phrases.setdefault(f" {phrase} ", []).append((label, weight, False))
        self.phrases = _automaton(phrases)
        self.tags = _automaton(dict.fromkeys(TAGS, True))

    def __call__(self, text: str | None) -> dict:
        """All columns of ``scan`` for one text."""
        data = (text or "").encode()
        spaced = b" " + data.translate(WORD_BYTES) + b" "
        while b"  " in spaced:
            spaced = spaced.replace(b"  ", b" ")
        # One character for each byte: the phrases are ASCII, so places and bounds are those of the bytes.
        line = spaced.decode("latin-1")
        base_at: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        weights: dict[str, float] = {}
        for end, (length, found) in self.phrases.iter(line):
            for label, weight, is_base in found:
                labels.add(label)
                weights[label] = max(weight, weights.get(label, 0.0))
                if is_base:
                    base_labels.add(label)
                    base_at.append(end - length + 1)
        expressions = self.expressions(data) if TAG_WORD.search(data) else []
        for expression in expressions:
            for name in expression.identifiers:
                for label in {name, family(name)} - {None}:
                    labels.add(label)
                    weights[label] = TAG_WEIGHT
        spaces = np.flatnonzero(np.frombuffer(spaced, dtype=np.uint8) == 32) if base_at else np.zeros(0, int)
        starts = np.searchsorted(spaces, base_at)
        return {
            "n_words": spaced.count(b" ") - 1,
            "n_base": len(base_at),
            "first_word": int(starts.min()) if base_at else None,
            "last_word": int(starts.max()) if base_at else None,
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(labels)),
            "score": 1.0 - float(np.prod([1 - w for w in weights.values()])) if weights else 0.0,
            "expressions": [e.text for e in expressions],
            "permissive": all(e.permissive for e in expressions) if expressions else None,
        }

    def expressions(self, data: bytes) -> list[Expression]:
        line = data.lower().decode("latin-1")
        found = []
        stop = 0
        for end, _ in self.tags.iter(line):
            if end >= stop:
                border = LINE_END.search(line, end + 1)
                stop = border.start() if border else len(line)
            if expression := evaluate(line, end + 1, stop):
                found.append(expression)
        return found


_scanner: list[Scanner] = []


def scanner() -> Scanner:
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "expressions array<string>, permissive boolean"
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and what the scan finds in every text; one row per row.

    n_words; n_base, first_word and last_word: places of the base phrases, by the word they start with;
    base_labels and labels: distinct, sorted, joined by commas, empty if none; score: 0 without a
    finding, else the chance that at least one is right; expressions: those after a tag, as written
    (an expression ends with its line, however long that is); permissive: whether all of them allow use
    with no more than a notice, null without any.

    A null text counts as empty, a very long one is scanned whole. Ids may be null or repeat; an empty
    table gives an empty result.
    """

    def columns(batch: list[str | None]) -> dict[str, list]:
        found = [scanner()(t) for t in batch]
        return {name: [f[name] for f in found] for name in found[0]}

    return append_columns(texts(docs, id_col, text_col), columns, SCHEMA, drop_text=True)


def op9_licenses(docs: DataFrame, _work=None) -> DataFrame:
    return scan(docs)
