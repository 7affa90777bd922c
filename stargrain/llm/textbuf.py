"""Arrow string columns as flat byte buffers, and vectorised word spans over them.

The Arrow-side operators never build one Python object per word: a column of
texts is one ``uint8`` buffer plus offsets, words are two index arrays, and a
word's identity is a 64-bit hash computed from prefix sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# digits, lower-case ASCII letters and every byte of a non-ASCII character
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_MUL = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_MUL, -1, 1 << 64)
_SEGMENT = 1 << 20


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run of bytes with ``table[byte]``; a text boundary ends a run."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = table[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_pow_cache: dict[str, np.ndarray] = {}


def _cached_powers(name: str, base: int, n: int) -> np.ndarray:
    have = _pow_cache.get(name)
    if have is None or len(have) < n:
        have = _powers(base, max(n, _SEGMENT + 4096))
        if n <= 2 * _SEGMENT:
            _pow_cache[name] = have
    return have


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, from prefix sums of a polynomial, in segments of bounded size."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _SEGMENT, side="right")))
        n = int(ends[to - 1]) - base
        up, down = _cached_powers("up", _MUL, n), _cached_powers("down", _INV, n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data[base:base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def hash_words(words: list[bytes]) -> np.ndarray:
    """The same hash for a list of words."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
    starts = ends - np.array([len(w) for w in words], dtype=np.int64)
    return word_hashes(data, starts, ends)


def code_point_offset(data: np.ndarray, text_start: int, byte: int) -> int:
    """Code points between a text's first byte and ``byte``."""
    part = data[text_start:byte]
    return int(len(part) - np.count_nonzero((part & 0xC0) == 0x80))
