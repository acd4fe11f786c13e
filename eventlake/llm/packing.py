"""Patched frame-of-reference coding of unsigned 32-bit values, in numpy.

A coded segment holds, little-endian: ``MAGIC``, the number of values, the
number of blocks and of exceptions (uint32 each); for each block its minimum
(uint32), width in bits (uint8), start of its packed words (uint32, counted in
words) and index of its first exception (uint32); the packed words (uint32);
each exception's place in its block (uint8) and full value (uint32). Blocks
have ``BLOCK`` values, the last one is filled up with its minimum.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
LANES = BLOCK // 32
MAGIC = b"PFB1"


def encode(values: np.ndarray, percentile: float = 0.9) -> bytes:
    """Codes one segment; a block's width fits ``percentile`` of its values above the minimum, the others are exceptions."""
    n = len(values)
    n_blocks = -(-n // BLOCK)
    grid = np.zeros(n_blocks * BLOCK, np.uint32)
    grid[:n] = values
    if n % BLOCK:
        grid[n:] = values[(n_blocks - 1) * BLOCK:].min()
    grid = grid.reshape(n_blocks, BLOCK)
    low = grid.min(1) if n else np.zeros(0, np.uint32)
    over = grid - low[:, None]
    typical = np.sort(over, axis=1)[:, min(BLOCK - 1, int(percentile * BLOCK))].astype(np.float64)
    width = np.where(typical > 0, np.floor(np.log2(np.maximum(typical, 1))) + 1, 0).astype(np.int64)
    block, place = np.nonzero(over.astype(np.uint64) >> width[:, None].astype(np.uint64))
    kept = over.copy()
    kept[block, place] = 0
    start = np.concatenate([[0], np.cumsum(width * LANES)])
    packed = np.zeros(start[-1], np.uint32)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        packed[(start[mine][:, None] + np.arange(w * LANES)).ravel()] = _pack(kept[mine], int(w)).ravel()
    first = np.searchsorted(block, np.arange(n_blocks))
    head = np.array([n, n_blocks, len(block)], "<u4")
    return b"".join([MAGIC, head.tobytes(), low.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(),
                     start[:-1].astype("<u4").tobytes(), first.astype("<u4").tobytes(), packed.astype("<u4").tobytes(),
                     place.astype(np.uint8).tobytes(), grid[block, place].astype("<u4").tobytes()])


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Each lane's 32 values into ``width`` words."""
    rows = rows.reshape(len(rows), 32, LANES)
    out = np.zeros((len(rows), width, LANES), np.uint32)
    for k in range(32):
        word, shift = divmod(k * width, 32)
        out[:, word] |= rows[:, k] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= rows[:, k] >> np.uint32(32 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    words = words.reshape(len(words), width, LANES)
    out = np.empty((len(words), 32, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for k in range(32):
        word, shift = divmod(k * width, 32)
        out[:, k] = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            out[:, k] |= words[:, word + 1] << np.uint32(32 - shift)
        out[:, k] &= mask
    return out.reshape(len(words), BLOCK)


def decode(segment: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The values of a segment, or of a range of its blocks only, found by the index of block starts."""
    if segment[:4] != MAGIC:
        raise ValueError("not a coded segment")
    n, n_blocks, n_exceptions = (int(x) for x in np.frombuffer(segment, "<u4", 3, 4))
    at = 16
    tables = []
    for kind, size in (("<u4", 4), ("u1", 1), ("<u4", 4), ("<u4", 4)):
        tables.append(np.frombuffer(segment, kind, n_blocks, at))
        at += size * n_blocks
    low, width, start, first = tables
    width, start, first = width.astype(np.int64), start.astype(np.int64), np.append(first.astype(np.int64), n_exceptions)
    n_words = int((width * LANES).sum())
    packed = np.frombuffer(segment, "<u4", n_words, at)
    place = np.frombuffer(segment, "u1", n_exceptions, at + 4 * n_words)
    value = np.frombuffer(segment, "<u4", n_exceptions, at + 4 * n_words + n_exceptions)
    last = n_blocks if last_block is None else min(last_block, n_blocks)
    picked = np.arange(first_block, max(first_block, last))
    out = np.repeat(low[picked][:, None], BLOCK, axis=1).astype(np.uint32)
    for w in np.unique(width[picked][width[picked] > 0]):
        mine = np.flatnonzero(width[picked] == w)
        words = packed[start[picked[mine]][:, None] + np.arange(w * LANES)]
        out[mine] += _unpack(words, int(w))
    if len(picked):
        a, b = first[picked[0]], first[picked[-1] + 1]
        block = np.searchsorted(first, np.arange(a, b), side="right") - 1 - first_block
        out[block, place[a:b]] = value[a:b]
    return out.ravel()[:max(0, n - first_block * BLOCK)]


def packed(values: np.ndarray) -> bytes:
    """64-bit values by planes of bytes: the upper ones are mostly zeros, which compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()
