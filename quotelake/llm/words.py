"""Texts to words as Arrow arrays, by classes of bytes; no Python code runs per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD, GAP, BREAK = 0, 1, 2
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def classes(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """A table of byte classes: bytes of words, gaps between words, and breaks between runs of words."""
    table = np.full(256, WORD, np.uint8)
    table[np.frombuffer(gaps, np.uint8)] = GAP
    table[np.frombuffer(breaks, np.uint8)] = BREAK
    return table


def slices(texts: pa.Array, room: int = 8_000_000) -> Iterator[tuple[int, pa.Array]]:
    """The texts in order in slices of about ``room`` bytes or one text, each with its first row; a null counts as empty."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + room)))
        yield start, pc.fill_null(texts.slice(start, stop - start), "")
        start = stop


def split(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of non-null texts with A-Z lower-cased: ``(names, codes, row, run)``.

    names: the distinct words; the others have a value a word: its name, its text,
    and its run, which differs from its neighbour's across a break or another text.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = bytes(body)[offsets[0] : offsets[-1]] if body is not None else b""
    at = offsets[:-1] - offsets[0]
    chars = np.frombuffer(data.translate(_LOWER), np.uint8)
    kind = table[chars]
    inside = kind == WORD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = at[at < len(chars)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    before = np.cumsum(inside, dtype=np.int32)
    bounds = np.append(before[starts] - 1, before[-1] if len(before) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(chars[inside]))
    coded = words.dictionary_encode()
    row = np.searchsorted(at, starts, "right") - 1
    run = np.cumsum(kind == BREAK, dtype=np.int64)[starts] + row
    return coded.dictionary, coded.indices.to_numpy(), row, run


def unique_counts(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of small numbers (column i below ``sizes[i]``), and how often each occurs."""
    key, room = columns[0].astype(np.int64), sizes[0]
    firsts = None
    for column, size in zip(columns[1:], sizes[1:], strict=True):
        if room * size >= 1 << 62:
            firsts, key = np.unique(key, return_inverse=True)
            room = len(firsts)
        key = key * size + column
        room *= size
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], n
