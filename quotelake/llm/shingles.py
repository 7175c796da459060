"""Word shingles of a text as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

# Any odd multiplier and table do; these follow from a seed.
_RANDOM = np.random.Generator(np.random.PCG64(20260101))
_TABLE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_P = int(_RANDOM.integers(1 << 62, 1 << 63, dtype=np.uint64)) | 1
_INVERSE = pow(_P, -1, 1 << 64)
_powers = {"n": 0}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse modulo 2**64."""
    if _powers["n"] < n:
        n = max(n, 2 * _powers["n"], 1 << 14)
        for name, base in (("up", _P), ("down", _INVERSE)):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Distinct hashes, ascending, of the runs of ``k`` words (the whole sequence if there are fewer; none without words).

    Words are divided by ASCII white space after A-Z are lower-cased.
    """
    data = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return np.empty(0, np.uint64)
    chars = np.frombuffer(data, np.uint8)
    up, down = _power(len(chars) + 1)
    total = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(_TABLE[chars] * up[: len(chars)], out=total[1:])
    gaps = np.flatnonzero(chars == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.append(gaps, len(chars))
    if len(starts) > k:
        starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    return np.unique(mix((total[ends] - total[starts]) * down[starts]))
