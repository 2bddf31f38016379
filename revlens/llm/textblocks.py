"""Words of Arrow string columns, found for blocks of texts at once with numpy.

A block is a run of rows whose UTF-8 bytes lie in one array. Texts are never
cut: a text larger than ``max_bytes`` is a block of its own. A null text is
read as empty; callers that must tell the two apart look at the column.

Words are ``[^\\x20\\x09-\\x0D]+``. Word and line identities are 64-bit hashes
of their bytes, taken from prefix sums of byte values times powers of an odd
base, which wrap at 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

#: Bytes with A-Z in lower case; all others as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The base (or its inverse) to the powers 0 to n - 1, kept per worker."""
    if len(_powers[kind]) < n:
        step = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        row = np.full(max(n, BLOCK_BYTES + 1), step, np.uint64)
        row[0] = 1
        _powers[kind] = np.cumprod(row, dtype=np.uint64)
    return _powers[kind][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Block:
    """Rows ``lo`` to ``hi`` of a batch: their bytes and where each row starts."""

    lo: int
    hi: int
    data: np.ndarray
    offs: np.ndarray
    _sums: np.ndarray | None = None

    def lower(self) -> "Block":
        return Block(self.lo, self.hi, LOWER[self.data], self.offs)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges ``[start, end)``."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_VALUES[self.data] * _power("up", len(self.data)), dtype=np.uint64, out=self._sums[1:])
        inverse = _power("down", len(self.data) + 1)
        return mix((self._sums[end] - self._sums[start]) * inverse[start] + (end - start).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row (counted from ``lo``) of every word."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        solid = ~SPACE[self.data]
        cut = self.offs[(self.offs > 0) & (self.offs < n)]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        first[cut] = solid[cut]
        last[cut - 1] = solid[cut - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(self.offs, start, side="right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are set in ``flags``."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offs[1:]] - sums[self.offs[:-1]]


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the row offsets (one more than rows) of a string column."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offs[0] : offs[-1]], offs - offs[0]


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of whole rows."""
    data, offs = text_arrays(column)
    lo, rows = 0, len(offs) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1)
        hi = min(hi, rows)
        yield Block(lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi
