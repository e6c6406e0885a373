"""Spans of bytes in the rows of a string column, over blocks of whole rows with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from siltstone.llm.wordhash import U64, hash_spans, mix, text_bytes

BLOCK_BYTES = 1 << 22


def byte_classes(**members: bytes) -> np.ndarray:
    """Class of each byte: the number of the set it is in, from 1 in the order given, else 0."""
    table = np.zeros(256, dtype=np.uint8)
    for number, held in enumerate(members.values(), 1):
        table[list(held)] = number
    return table


@dataclass
class Spans:
    """Rows first..first+rows of a batch and the longest runs of bytes of class 0 in each."""

    first: int
    rows: int
    data: np.ndarray
    classes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # row i has the spans bounds[i] .. bounds[i + 1]

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each span."""
        return hash_spans(self.data, self.starts, self.ends), hash_spans(self.data ^ np.uint8(128), self.starts, self.ends)


def span_blocks(texts: pa.Array, classes: np.ndarray, lower: bool = False, block_bytes: int = BLOCK_BYTES) -> Iterator[Spans]:
    """The column in blocks of whole rows of about `block_bytes` (or one longer row); `lower` folds A-Z first."""
    raw, offsets = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + block_bytes, side="right")) - 1)
        at = offsets[row : stop + 1] - offsets[row]
        data = raw[offsets[row] : offsets[stop]]
        if lower:
            data = data + (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
        kinds = classes[data]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = kinds == 0
        edge = np.zeros(len(data) + 1, dtype=bool)  # a row begins here
        edge[at] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        yield Spans(row, stop - row, data, kinds, starts, ends, np.searchsorted(starts, at))
        row = stop


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Text data[start:end] for each pair; they may overlap and come in any order."""
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def chained(hashes: list[np.ndarray], salt: int) -> np.ndarray:
    """One hash of several in order, for each row."""
    total = np.full(len(hashes[0]), U64(salt))
    for h in hashes:
        total = mix(total * U64(0xD6E8FEB86659FD93) + h)
    return total
