"""Words and their hashes straight from Arrow string buffers, by numpy.

No Python object per word: words are found as byte ranges of the batch's text
buffer, and their 64-bit hashes come from one prefix sum.  Work goes in slices
of whole rows of about ``SLICE_BYTES``, which bounds the temporary arrays; a
single longer text is a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset:]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Ranges of rows of at most ``most`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's last step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(lower: bool) -> np.ndarray:
    """A 64-bit code per byte value; with ``lower``, A-Z share the codes of a-z."""
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", INVERSE)):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


class PrefixHash:
    """Hashes of any ranges of one symbol sequence, equal for equal symbols.

    ``symbols`` are indexes into ``codes`` (a 64-bit code per symbol), or the
    codes themselves where ``codes`` is None.
    """

    def __init__(self, symbols: np.ndarray, powers: Powers, codes: np.ndarray | None = None):
        up, self.down = powers.upto(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        values = symbols if codes is None else codes[symbols]
        np.cumsum(values * up[:len(symbols)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words end at ASCII white space and at row ends."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = is_space(data)
    brk = np.ones(len(data) + 1, bool)
    brk[1:-1] = space[:-1]
    brk[offsets] = True
    start = np.flatnonzero(~space & brk[:-1])
    brk[:-1] |= space
    brk[offsets] = True
    ends = np.flatnonzero(brk)
    end = ends[np.searchsorted(ends, start, side="right")]
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of marked bytes; runs end at row ends."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (edge[:-1] | np.append(True, ~inside[:-1])[:len(inside)]))
    end = np.flatnonzero(inside & (edge[1:] | np.append(~inside[1:], True)[:len(inside)])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def run_strings(data: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The runs' bytes as one binary Arrow array, without a Python object per run."""
    bounds = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=bounds[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start),
                                            [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32))
