"""Words of UTF-8 text and their 64-bit hashes, over whole Arrow batches with numpy.

A word is a longest run of characters other than blank and U+0009..U+000D. Those
six never occur inside a longer UTF-8 sequence, so bytes can be split as they are.
Memory: a few arrays of the bytes of one block of rows (about BLOCK_BYTES, or one
text if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from siltstone.llm.common import per_process

BLOCK_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
U64 = np.uint64

_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept up to the usual block."""
    usual = BLOCK_BYTES + 1
    return per_process(f"powers {base}", lambda: _powers(base, usual))[:n] if n <= usual else _powers(base, n)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK_BYTES, side="right")))
        base, stop = int(starts[lo]), int(ends[hi - 1])
        sums = np.zeros(stop - base + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data[base:stop]] * _power(MULTIPLIER, stop - base), out=sums[1:])
        at, to = starts[lo:hi] - base, ends[lo:hi] - base
        total = (sums[to] - sums[at]) * _power(INVERSE, stop - base)[at]
        out[lo:hi] = mix(total + (to - at).astype(np.uint64))
        lo = hi
    return out


@dataclass
class Block:
    """Rows first..last of a batch: bytes, word spans in them, and each row's words."""

    first: int
    rows: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # row i has the words bounds[i] .. bounds[i + 1]
    byte_bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array (null: none) and the bounds of each row in them."""
    texts = texts.cast(pa.large_string()).fill_null("") if len(texts) else pa.array([], pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def word_blocks(texts: pa.Array, lower: bool = False) -> Iterator[Block]:
    """The batch in blocks of whole rows; `lower` turns A-Z into a-z first."""
    raw, offsets = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1)
        byte_bounds = offsets[row : stop + 1] - offsets[row]
        data = raw[offsets[row] : offsets[stop]]
        if lower:
            data = data + (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.zeros(len(data) + 1, dtype=bool)  # a row begins here
        edge[byte_bounds] = True
        before = np.concatenate(([False], inside[:-1])) if len(data) else inside
        after = np.concatenate((inside[1:], [False])) if len(data) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield Block(row, stop - row, data, starts, ends, np.searchsorted(starts, byte_bounds), byte_bounds)
        row = stop


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive values; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total *= U64(0xD6E8FEB86659FD93)
        total += hashes[i : i + n]
    return mix(total + U64(size))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles in order; fewer words than `size` make one shingle, none make none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    return np.unique(window_hashes(hashes, min(size, len(hashes))))
