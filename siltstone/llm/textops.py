"""Words, windows and hashes over Arrow batches of texts, as whole-array numpy work.

A batch is cut into pieces of about `PIECE` bytes of whole rows, so memory follows the piece
(or one longer text), not the batch. Hashes are 64 bit and equal on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space, controls and ASCII punctuation.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept up to a few pieces' length."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(1 << n.bit_length(), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * PIECE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of a piece: byte spans, hashes, and the first word of each row (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def pieces(column: pa.Array, rows: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of rows in them); NULL counts as empty.

    `rows` bounds a piece's rows as well, for work that is wide in each row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
        to = min(to, at + rows) if rows else to
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, fold: bool = True) -> Words:
    """Maximal runs of bytes that are no separators; with `fold`, A-Z hash as a-z."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    apart = separators[data]
    opens, closes = ~apart, ~apart
    filled = offsets[:-1] < offsets[1:]
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    at_first, at_last = opens[firsts], closes[lasts]
    opens[1:] &= apart[:-1]
    closes[:-1] &= apart[1:]
    opens[firsts], closes[lasts] = at_first, at_last
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    value = (_FOLDED if fold else _VALUES)[data]
    value *= _power(_BASE, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(value, dtype=np.uint64, out=total[1:])
    spread = (total[end] - total[start]) * _power(pow(_BASE, -1, 1 << 64), n)[start]
    return Words(start, end, mix(spread), np.searchsorted(start, offsets))


def windows(found: Words, size: int, places: tuple[int, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word windows inside rows, and the index of each one's first word.

    `places` are the positions of a window that count, all by default.
    """
    n = len(found.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(found.first) - 1), found.counts)
    inside = np.flatnonzero(row[:n] == row[size - 1 :])
    out = np.full(n, 0x2545F4914F6CDD1D * (size + 1) % 2**64, dtype=np.uint64)
    for i in places if places is not None else range(size):
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out += found.hash[i : i + n]
        out ^= out >> np.uint64(31)
    return mix(out)[inside], inside
