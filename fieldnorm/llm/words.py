"""Words of Arrow text columns as arrays: byte places and 64-bit hashes, no Python per word.

Hashes are polynomials over bytes (or over word hashes) modulo 2**64, taken from running
sums, so that every window of a text costs one subtraction. They depend on the words alone.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at a time
LIMIT = 1 << 20  # bytes of text in a slice of a batch, if it has more than one row

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SIGN = np.ones(256, bool)
_SIGN[0x30:0x3A] = _SIGN[0x41:0x5B] = _SIGN[0x61:0x7B] = _SIGN[0x80:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_BASE = {"byte": 0x5851F42D4C957F2D | 2 | 1, "word": 0xD1342543DE82EF95 | 2 | 1, "check": 0x2545F4914F6CDD1D | 2 | 1}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2**64."""
    if kind not in _powers or len(_powers[kind][0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _BASE[kind], np.uint64)
        down = np.full(size, pow(_BASE[kind], -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[kind] = np.cumprod(up), np.cumprod(down)
    up, down = _powers[kind]
    return up[:n], down[:n]


def sums(kind: str, values: np.ndarray) -> np.ndarray:
    """Running sums of values times powers, with a zero in front."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(kind, len(values))[0], out=out[1:])
    return out


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, wherever it starts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = sums("word", words)
    return mixed((total[size:] - total[:n]) * powers("word", n)[1] + np.uint64(size))


@dataclass
class Words:
    """Words of a slice of rows. Row r has words ``first[r]`` to ``first[r + 1]``."""

    data: np.ndarray  # bytes of all texts, one after the other
    row: np.ndarray  # where each row's bytes start; one more entry than rows
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def owner(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def until(self) -> np.ndarray:
        """For each word, the end of its row's words."""
        return np.repeat(self.first[1:], np.diff(self.first))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: str = "byte") -> np.ndarray:
    """Hashes of the bytes of spans that are in order and don't overlap."""
    out, a = np.zeros(len(start), np.uint64), 0
    while a < len(start):
        at = start[a]
        b = max(a + 1, int(np.searchsorted(end, at + PIECE, side="right")))
        total = sums(lane, _BYTE[data[at : end[b - 1]]])
        s, e = start[a:b] - at, end[a:b] - at
        out[a:b] = mixed((total[e] - total[s]) * powers(lane, len(total))[1][s])
        a = b
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (one more at the end)."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if raw is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, *, signs: bool, lower: bool, hashes: bool = True) -> Words:
    """Words between white space, or (``signs``) of letters, digits and non-ASCII characters.

    ``lower`` lower-cases A-Z. Null texts have no words.
    """
    data, row = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~(_SIGN if signs else _SPACE)[data]
    begins = np.zeros(len(data), bool)
    begins[row[:-1][row[:-1] < len(data)]] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:]
    start = np.flatnonzero(starts)
    ends = inside
    ends[:-1] &= ~inside[1:] | begins[1:]
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, row)
    return Words(data, row, first, start, end, span_hashes(data, start, end) if hashes else np.zeros(0, np.uint64))


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a few megabytes of text, so that arrays stay small."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + LIMIT, side="right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def _give_back() -> None:
    """Return freed memory to the machine: Spark keeps idle Python workers, and they keep theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(scan: Callable) -> Callable:
    """``scan``, a function for ``mapInArrow``, as one whose workers hold no memory between tasks."""

    @functools.wraps(scan)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            _give_back()

    return run
