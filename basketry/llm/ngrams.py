"""Hashed character n-grams of a batch of texts, as numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# A slice of an Arrow batch is worked on at once; it holds so many characters or a single text.
SLICE_CHARS = 400_000
BORDER = re.compile(r"\S(?=[ \t\n\r\f\v])")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[str | None]]]:
    """(start row, texts) of consecutive rows with about ``SLICE_CHARS`` characters together."""
    held = batch.column(column).to_pylist() if batch.num_rows <= 64 else None
    start = 0
    while start < batch.num_rows:
        part: list[str | None] = []
        size = 0
        row = start
        while row < batch.num_rows and (size < SLICE_CHARS or not part):
            text = held[row] if held is not None else batch.column(column)[row].as_py()
            part.append(text)
            size += len(text or "")
            row += 1
        yield start, part
        start = row


def segments(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut before white space: what works on words stays bounded."""
    start = 0
    while len(text) - start > size and (border := BORDER.search(text, start + size)):
        yield text[start : border.end()]
        start = border.end()
    yield text[start:] if start else text


def hashed(texts: Sequence[str | None], sizes: Sequence[int], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, features below 2**width of n-grams, text after text, how many of them each text has).

    Texts are lower-cased and padded with a space on either side, so that n-grams see word ends;
    null counts as empty. A text shorter than a size has no n-gram of it. Each size comes once, or
    several times for a very long text, which is worked on in overlapping parts.
    """
    padded = [f" {(t or '').lower()} " for t in texts]
    if len(padded) == 1 and len(padded[0]) > 2 * SLICE_CHARS:
        whole, reach = padded[0], max(sizes) - 1
        for at in range(0, len(whole), SLICE_CHARS):
            yield from _hashed([whole[at : at + SLICE_CHARS + reach]], sizes, width, SLICE_CHARS)
    else:
        yield from _hashed(padded, sizes, width, None)


def _hashed(
    padded: Sequence[str], sizes: Sequence[int], width: int, starts: int | None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The n-grams of texts, or those that begin in the first ``starts`` characters of a single one."""
    chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lengths = np.array([len(p) for p in padded], dtype=np.int64)
    ends = np.cumsum(lengths)
    code = np.zeros(len(chars), dtype=np.uint64)
    for size in range(1, max(sizes) + 1):
        code = code[: len(chars) - size + 1] * MULTIPLIER + chars[size - 1 :]
        if size not in sizes:
            continue
        feature = (((code ^ (code >> np.uint64(29))) * MULTIPLIER) >> np.uint64(64 - width)).astype(np.int32)
        inside = np.ones(len(chars), dtype=bool)
        for back in range(1, size):
            inside[(ends - back)[ends >= back]] = False
        feature, counts = feature[inside[: len(feature)]], np.maximum(lengths - size + 1, 0)
        if starts is not None:
            feature, counts = feature[:starts], np.minimum(counts, starts)
        yield size, feature, counts


def per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``counts`` rows of ``values``; zero where the count is zero."""
    out = np.zeros((len(counts), *values.shape[1:]), dtype=np.float64)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
