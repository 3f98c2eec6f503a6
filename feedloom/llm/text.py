"""Words and shingles of many texts at once, as arrays over their UTF-8 bytes.

All functions are used inside Arrow batches on executors. A word is a maximal run of word bytes;
which bytes those are is a table of 256 truth values, so rules on ASCII separators are exact on
UTF-8. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about this many bytes; one text is never cut.
PIECE = 1 << 21

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = _U(pow(int(_P), -1, 1 << 64))
_Q = _U(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values; one-to-one for each seed."""
    x = x ^ _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    """A random value for each byte, the same for A-Z as for a-z."""
    folded = np.arange(256, dtype=np.uint64)
    folded[65:91] += _U(32)
    return mix(folded, 7)


#: Words between white space: ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Letters, digits and everything beyond ASCII, after lower-casing.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        np.multiply.accumulate(np.full(n - 1, base), out=out[1:])
    return out


class _Tables:
    """Powers up to the longest piece seen; made in each Python worker."""

    size = 0
    up: np.ndarray
    down: np.ndarray
    values: np.ndarray

    @classmethod
    def upto(cls, n: int) -> type[_Tables]:
        if cls.size < n:
            cls.size = max(n, PIECE + PIECE // 4)
            cls.up, cls.down = _powers(_P, cls.size), _powers(_P_INVERSE, cls.size)
            cls.values = _byte_values()
        return cls


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the ``n + 1`` offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or ends[-1] == ends[0]:
        return np.empty(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each, at least one row."""
    _, ends = utf8(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def hash_words(
    data: np.ndarray, ends: np.ndarray, word_bytes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and the ``n + 1`` word offsets of the texts.

    Bytes are cut between words, so the helper arrays stay small for texts of any length.
    """
    is_word = word_bytes[data]
    change = np.empty(len(data), dtype=bool)
    if len(data):
        change[0] = True
        np.not_equal(is_word[1:], is_word[:-1], out=change[1:])
    inner = ends[1:-1]
    change[inner[inner < len(data)]] = True
    cuts = np.flatnonzero(change)
    kept = is_word[cuts]
    starts = cuts[kept]
    stops = np.append(cuts[1:], len(data))[kept]
    hashes = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(stops, starts[first] + PIECE, side="right"))
        last = max(last, first + 1)
        a, b = int(starts[first]), int(stops[last - 1])
        tables = _Tables.upto(b - a + 1)
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(tables.values[data[a:b]] * tables.up[: b - a], out=sums[1:])
        s, e = starts[first:last] - a, stops[first:last] - a
        hashes[first:last] = (sums[e] - sums[s]) * tables.down[s]
        first = last
    return mix(hashes), np.searchsorted(starts, ends)


def shingles(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending.

    A text of fewer words is one shingle as a whole; a text without words has none.
    """
    n = len(words)
    mixed = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    factors = _powers(_Q, size)
    for j in range(size if len(mixed) else 0):
        mixed += words[j : n - size + 1 + j] * factors[j]
    mixed = mix(mixed, 3)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(mixed[a : b - size + 1]))
        elif b > a:
            whole = (words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(whole, 3))
        else:
            out.append(mixed[:0])
    return out


def shingle_sets(column: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The shingle sets of a piece of a string column, over words between white space."""
    data, ends = utf8(column)
    words, bounds = hash_words(data, ends, SPACED)
    return shingles(words, bounds, size)


def digest_pair(values: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of an array, 128 bits together."""
    import xxhash

    whole = xxhash.xxh3_128_digest(values.tobytes())
    return int.from_bytes(whole[:8], "big", signed=True), int.from_bytes(
        whole[8:], "big", signed=True
    )
