"""Vectorised text primitives over Arrow string columns.

Every free-style operator of this subpackage reads texts as Arrow batches.  The helpers here work on the
raw UTF-8 buffer of such a batch: they cut it into bounded slices, find words or tokenizer units with byte
masks, and hash all of them with one prefix sum, so no Python code runs per word.

Null texts count as empty.  A slice holds whole documents; a document longer than ``SLICE_BYTES`` forms a
slice of its own, so memory follows the longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: Word separators of the data contracts: space and the bytes 9 to 13.
_SEP = np.zeros(256, dtype=bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True

_MULT = 0x9E3779B97F4A7C15 | 1
_MULT_INV = pow(_MULT, -1, 1 << 64)

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done, step = 1, base
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * np.uint64(step)
        done, step = done + take, (step * step) % (1 << 64)
    return out


_pow_cache: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, below n; the cache keeps no more than four slices' worth."""
    if len(_pow_cache["up"]) >= n:
        return _pow_cache["up"], _pow_cache["down"]
    up, down = _powers(_MULT, n), _powers(_MULT_INV, n)
    if n <= 4 * SLICE_BYTES:
        _pow_cache.update(up=up, down=down)
    return up, down


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Slice:
    """Some whole documents of a batch: ``buf`` holds their bytes, ``offs`` the n + 1 document bounds in it."""

    def __init__(self, first: int, buf: np.ndarray, offs: np.ndarray):
        self.first, self.buf, self.offs = first, buf, offs

    def __len__(self) -> int:
        return len(self.offs) - 1

    def doc_starts(self) -> np.ndarray:
        flag = np.zeros(len(self.buf) + 1, dtype=bool)
        flag[self.offs] = True
        return flag

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offs, positions, side="right") - 1

    def prefix(self, lower: bool = False) -> np.ndarray:
        up, _ = _pow(len(self.buf) + 1)
        out = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.buf] * up[: len(self.buf)], out=out[1:])
        return out

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False, prefix: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each span's bytes, wherever it stands."""
        c = self.prefix(lower) if prefix is None else prefix
        _, down = _pow(len(self.buf) + 1)
        return mix64((c[ends] - c[starts]) * down[starts])

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of non-separator bytes; no run crosses documents."""
        n = len(self.buf)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sep, doc = _SEP[self.buf], self.doc_starts()
        before = np.ones(n, dtype=bool)
        before[1:] = sep[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = sep[1:]
        starts = np.flatnonzero(~sep & (before | doc[:n]))
        ends = np.flatnonzero(~sep & (after | doc[1:])) + 1
        return starts, ends


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a string column, as slices of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offs = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(column))
        yield Slice(i, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        i = j


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of a fixed-width array as one binary column; ``bounds`` counts elements."""
    offs = pa.py_buffer((bounds * values.dtype.itemsize).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offs, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


_CRC_POLY = 0xEDB88320


def _crc_mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo the CRC-32 polynomial, bits reversed as in the checksum."""
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    out = np.zeros(np.broadcast(a, b).shape, np.uint64)
    one = np.uint64(1)
    for i in range(31, -1, -1):
        out ^= np.where(a >> np.uint64(i) & one, b, np.uint64(0))
        b = np.where(b & one, b >> one ^ np.uint64(_CRC_POLY), b >> one)
    return out


def crc_shift(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What each checksum contributes to that of a longer text in which so many bytes follow; contributions XOR together."""
    power = np.array([1 << 23], np.uint64)  # x to the 8th
    factor = np.full(len(crc), 1 << 31, np.uint64)
    left = zeros.astype(np.int64)
    while left.any():
        odd = (left & 1).astype(bool)
        if odd.any():
            factor[odd] = _crc_mul(factor[odd], power)
        power = _crc_mul(power, power)
        left = left >> 1
    return _crc_mul(factor, crc.astype(np.uint64))
