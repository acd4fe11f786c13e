"""Whole texts as byte blocks: word bounds and hashes for many rows at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = (np.arange(256) & 0xC0) == 0x80


class Block(NamedTuple):
    """Some rows' texts in one buffer, a line feed after each."""

    first: int          # index of the first row in its batch
    data: np.ndarray    # uint8
    rows: np.ndarray    # int64, where each row begins; one more at the end

    @property
    def n(self) -> int:
        return len(self.rows) - 1


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # index of each row's first word; one more at the end

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def views(values: pa.Array) -> list[memoryview]:
    """The bytes of a text or binary column, row by row and without a copy; null has none."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if not len(values):
        return []
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, len(values) + 1, values.offset * (8 if wide else 4)).tolist()
    held = memoryview(data if data is not None else b"")
    out = [held[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
    if values.null_count:
        for k in np.flatnonzero(values.is_null().to_numpy(zero_copy_only=False)):
            out[k] = held[:0]
    return out


def blocks(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cuts a text column into blocks of about ``max_bytes``; null counts as empty, a long text stays whole."""
    values = views(texts)
    first = 0
    while first < len(values):
        last, size = first, 0
        while last < len(values) and (last == first or size + len(values[last]) < max_bytes):
            size += len(values[last]) + 1
            last += 1
        part = values[first:last]
        rows = np.zeros(len(part) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in part], out=rows[1:])
        yield Block(first, np.frombuffer(b"\n".join(part) + b"\n", np.uint8), rows)
        first = last


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; the last value must be false."""
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        turns = np.concatenate(([0], turns))
    return turns[0::2], turns[1::2]


def words(block: Block, inside: np.ndarray | None = None) -> Words:
    """Runs of bytes other than white space, or of the bytes marked in a table of 256."""
    starts, ends = runs((~SPACE if inside is None else inside)[block.data])
    return Words(starts, ends, np.searchsorted(starts, block.rows))


class _Powers:
    """Powers of the base and their inverses, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if n > len(cls.up):
            size = max(n, 2 * len(cls.up), BLOCK_BYTES * 2)
            for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(size, x, np.uint64)
                factors[0] = 1
                setattr(cls, name, np.cumprod(factors, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Hasher:
    """64-bit hashes of any byte ranges of one buffer, from running polynomial sums."""

    def __init__(self, data: np.ndarray):
        _Powers.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _Powers.up[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spans = (self.sums[ends] - self.sums[starts]) * _Powers.down[starts]
        return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def combined(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of hashes, in their order."""
    _Powers.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _Powers.up[:len(hashes)], out=sums[1:])
    return mix((sums[high] - sums[low]) * _Powers.down[low] + (high - low).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows within a row, and where each window starts (index of its word)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    whole = np.zeros(n, np.uint64)
    for k in range(size):
        whole = (whole + hashes[k:k + n]) * np.uint64(_BASE)
    # Word i starts a window if word i + size - 1 is still in its row.
    room = np.repeat(bounds[1:], np.diff(bounds))[:n] - np.arange(n)
    at = np.flatnonzero(room >= size)
    return mix(whole[at]), at


def distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each owner, by owner then key, and the bounds of each of ``n`` owners."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(n + 1))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, where ``bounds`` has each row's first; rows may be empty."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64) if values.dtype.kind in "iub" else values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
