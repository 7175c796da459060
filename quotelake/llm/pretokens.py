"""Splitting of texts into pre-tokens, with caches for those seen before.

The public pattern never joins two pre-tokens across a single space that stands
between two visible characters: the space begins the next pre-token. So a text
is cut at its spaces first (C speed), and what a chunk gives is remembered.
Only white space of several characters with a space inside, of which the
pattern gives the last space to the next word, needs the whole text at once;
``AMBIGUOUS`` finds such texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

AMBIGUOUS = re.compile(r"\s (?:\s|\Z)")
#: Below it, every code point is assigned.
HIGH = re.compile("[\u0378-\U0010ffff]")


def unassigned() -> re.Pattern:
    """Finds characters that this Python's Unicode version has not assigned."""
    out, start = [], None
    for cp in range(0x110001):
        none = cp < 0x110000 and unicodedata.category(chr(cp)) == "Cn"
        if none and start is None:
            start = cp
        elif not none and start is not None:
            out.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return re.compile("[" + "".join(out) + "]")


def gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows ``which`` of ``flat`` one after the other, and where each ends."""
    many = n[which]
    end = np.cumsum(many)
    return flat[np.repeat(start[which] - (end - many), many) + np.arange(end[-1] if len(end) else 0)], end


class Store:
    """Strings with the ids that each gives, as ragged arrays; short ones are kept, up to ``limit`` (some 40 bytes each)."""

    LONGEST = 64

    def __init__(self, limit: int):
        self.limit = limit
        self.names, self.flat, self.n = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def get(self, names: pa.Array, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ragged rows of distinct names: ids, starts, lengths. make: ids and lengths of new ones."""
        at = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if not len(new):
            return self.flat, (np.cumsum(self.n) - self.n)[at], self.n[at]
        fresh = names.take(pa.array(new))
        ids, n = make(fresh.to_pylist())
        at[new] = len(self.n) + np.arange(len(new))
        flat, many = np.concatenate([self.flat, ids]), np.concatenate([self.n, n])
        start = np.cumsum(many) - many
        short = np.flatnonzero(pc.binary_length(fresh).to_numpy() <= self.LONGEST)[: max(0, self.limit - len(self.n))]
        if len(short):
            kept, _ = gather(flat, start, many, len(self.n) + short)
            self.names = pa.concat_arrays([self.names, fresh.take(pa.array(short))])
            self.flat, self.n = np.concatenate([self.flat, kept]), np.concatenate([self.n, n[short]])
        return flat, start[at], many[at]


class TextEncoder:
    """Texts to flat arrays of token ids.

    pieces: gives a list of pre-tokens' bytes, little-endian unsigned 32-bit ids.
    whole: gives those of a text for which the regular expression of this process
    may split otherwise than the library does, because a character is not
    assigned in its Unicode version. Arrow tells the chunks between single spaces
    and the pre-tokens apart, so Python meets new ones only; what they give is
    kept in two stores of bounded size.
    """

    def __init__(self, pattern: str, pieces: Callable[[list[str]], list[bytes]], whole: Callable[[str], bytes], limit: int = 400_000, room: int = 2_000_000):
        self.room = room  # bytes of text in a slice; every slice looks its chunks up in the stores anew
        self.split, self.odd = regex.compile(pattern), unassigned()
        self.pieces, self.whole = pieces, whole
        self.seen, self.chunks = Store(limit), Store(limit)

    def unknown(self, text: str) -> bool:
        return not text.isascii() and bool(HIGH.search(text) and self.odd.search(text))

    def _pieces(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.pieces(names)
        return np.frombuffer(b"".join(got), "<u4"), np.fromiter(map(len, got), np.int64, len(got)) // 4

    def _resolve(self, plain: list[str], alone: list[str], given: dict[int, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths: of chunks that begin and end visibly, each after a single space, then of texts as they are.

        One call splits all such chunks, joined by spaces: a pre-token that begins
        with a space begins a chunk. given: what is known already, by place in ``alone``.
        """
        given = dict(given or {})
        found = self.split.findall(" " + " ".join(plain)) if plain else []
        first = [k for k, piece in enumerate(found) if piece[0] == " "]
        for i, text in enumerate(alone):
            first.append(len(found))
            if i not in given:
                if self.unknown(text):
                    given[i] = self.whole(text)
                else:
                    found += self.split.findall(text)
        coded = pa.array(found, pa.string()).dictionary_encode()
        ids, end = gather(*self.seen.get(coded.dictionary, self._pieces), coded.indices.to_numpy())
        bounds = np.concatenate(([0], end))[np.array([*first, len(found)], np.int64)]
        if given:
            parts = np.split(ids, bounds[1:-1])
            for i, data in given.items():
                parts[len(plain) + i] = np.frombuffer(data, "<u4")
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, np.diff(bounds)

    def _chunks(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of distinct chunks, each after a single space."""
        fine = np.array([bool(c) and not c[0].isspace() and not c[-1].isspace() and not self.unknown(c) for c in names], bool)
        plain, rest = np.flatnonzero(fine), np.flatnonzero(~fine)
        ids, n = self._resolve([names[i] for i in plain], [" " + names[i] for i in rest])
        if not len(rest):
            return ids, n
        place = np.empty(len(names), np.int64)
        place[np.concatenate([plain, rest])] = np.arange(len(names))
        return gather(ids, np.cumsum(n) - n, n, place)[0], n[place]

    def encode(self, texts: list[str] | pa.Array, special: Callable[[str], bytes | None] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, offsets)`` of slices of the texts in order, each of bounded size or one text; a null text counts as empty.

        special: what a text gives that is to be encoded otherwise, else None.
        """
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + self.room)))
            yield self._slice(pc.fill_null(texts.slice(start, stop - start), ""), special)
            start = stop

    def _slice(self, texts: pa.Array, special: Callable[[str], bytes | None] | None) -> tuple[np.ndarray, np.ndarray]:
        """A text that can't be cut at its spaces is one chunk."""
        alone, given = {}, {}
        for i, text in enumerate(texts.to_pylist()):
            if special and (got := special(text)) is not None:
                alone[i], given[i] = "", got
            elif AMBIGUOUS.search(text) or self.unknown(text):
                alone[i] = text
        if alone:
            texts = pc.if_else(pa.array(np.isin(np.arange(len(texts)), list(alone))), "", texts)
        parts = pc.split_pattern(texts, " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        at -= at[0]
        coded = parts.flatten().dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary
        # A text's first chunk has no space before it.
        heads = names.take(pa.array(codes[at[:-1]])).to_pylist()
        head_ids, head_n = self._resolve([], [alone.get(i, head) for i, head in enumerate(heads)], given)
        inner = np.ones(len(codes), bool)
        inner[at[:-1]] = False
        used = np.zeros(len(names), bool)
        used[codes[inner]] = True
        ids, start, n = self.chunks.get(names.filter(pa.array(used)), self._chunks)
        order = (np.cumsum(used) - 1)[codes]
        order[at[:-1]] = len(n) + np.arange(len(texts))
        start = np.concatenate([start, len(ids) + np.cumsum(head_n) - head_n])
        out, end = gather(np.concatenate([ids, head_ids]), start, np.concatenate([n, head_n]), order)
        return out, np.concatenate(([0], end[at[1:] - 1]))
