"""Words of a batch of texts as numpy arrays: one pass over the bytes, no Python object per word.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. Hashes are 64-bit polynomials over the bytes, scrambled at the end,
so any stretch of bytes (a word, its first letters, its last ones) gets its hash from two running sums.
Batches are taken in pieces of bounded size, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text taken at once; a longer text makes a piece of its own.
PIECE_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def scramble(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one mixing of 64-bit values; each seed gives another order of them."""
    x = x + np.uint64((seed * 0xD1B54A32D192ED03 + _BASE) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = scramble(np.arange(256, dtype=np.uint64), 77)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << n.bit_length()
        for name, base in (("_powers", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverse


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text starts (one entry more); null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, starts) of consecutive stretches of about ``limit`` bytes at most."""
    raw, starts = text_bytes(column)
    low, n = 0, len(starts) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + limit, "right")) - 1)
        yield low, high, raw[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
        low = high


class Words:
    """The words of one piece: ``first``/``last`` byte of each, ``at`` (first word of each text, one entry more)."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, lower: bool = True, is_word: np.ndarray | None = None):
        self.bytes = LOWER[raw] if lower else raw
        self.starts = starts
        inside = np.zeros(len(raw) + 1, bool)
        inside[:-1] = ~SPACE[raw] if is_word is None else is_word[raw]
        begins, ends = inside[:-1].copy(), inside[:-1].copy()
        begins[1:] &= ~inside[:-2]
        ends &= ~inside[1:]
        edges = starts[:-1][starts[:-1] < len(raw)]  # a text border also ends a word
        begins[edges] = inside[edges]
        before = edges[edges > 0] - 1
        ends[before] = inside[before]
        self.first = np.flatnonzero(begins)
        self.last = np.flatnonzero(ends)
        self.at = np.searchsorted(self.first, starts)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def span_hash(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Hash of the bytes in [low, high), the same wherever they stand."""
        n = len(self.bytes)
        powers, inverse = _power_tables(n + 1)
        if self._sums is None:
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.bytes] * powers[:n], out=self._sums[1:])
        return scramble((self._sums[high] - self._sums[low]) * inverse[low])

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.first, self.last + 1)


def grams(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside one text, and the text of each, in order of place."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out = scramble(out, i) + hashes[i : i + n]
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    same = text[:n] == text[k - 1 :]
    return scramble(out[same], k), text[:n][same]


def sets(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each text: values grouped by text, and where each text's begin.

    A text of fewer words has its whole sequence as one shingle; a text without words has none.
    """
    values, text = grams(hashes, at, k)
    counts = np.diff(at)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.array([_sequence(hashes[at[i] : at[i + 1]], k) for i in short], np.uint64)
        values, text = np.concatenate([values, whole]), np.concatenate([text, short])
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
        values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(len(at)))


def _sequence(hashes: np.ndarray, k: int) -> np.uint64:
    out = np.uint64(len(hashes) + 1000 * k)
    one = np.array([out])
    for h in hashes:
        one = scramble(one, 3) + h
    return scramble(one, 5)[0]
