"""Removal of word sequences that occur more than once, by difference-cover anchors.

A window of `length` words is repeated if its word sequence also starts anywhere
else, in the same text or another. A difference cover D of a period v holds, for
any two positions, an offset under v that brings both into D modulo v. So two equal
windows share an anchor: a run of length - v + 1 words that begins at a cover
position in either text. Steps:

1. hash the anchors (|D| of every v positions) and count equal ones;
2. keep the anchors that occur twice or more, gathered per text;
3. extend: hash the whole windows around these anchors (96 bits) and count them;
4. take out each word that a window found twice covers.

Counting is a partial sum per task, and the joins back are ones that AQE can split,
so an anchor or window that a third of all texts share lands in no single task.
Rows are known by a hash of id and text, so rows that repeat both are one key whose
windows count twice. A null or empty text has no words. Other columns are carried
along, unless named like one of the new columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, whole_row, with_rest, written
from siltstone.llm.wordhash import U64, mix, window_hashes, word_blocks

# Perfect difference sets, one for each period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of two fifths of the window."""
    period = max(v for v in COVERS if length - v + 1 >= max(1, 2 * length // 5))
    return period, COVERS[period]


def _anchors(length: int):
    period, cover = cover_for(length)
    size = length - period + 1
    allowed = np.zeros(period, dtype=bool)
    allowed[list(cover)] = True

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for block in word_blocks(batch.column(1)):
                hashes = window_hashes(block.hashes(), size)
                row = np.repeat(np.arange(block.rows), np.diff(block.bounds))[: len(hashes)]
                pos = np.arange(len(hashes)) - block.bounds[row]
                words = np.diff(block.bounds)[row]
                keep = np.flatnonzero((pos + size <= words) & (words >= length) & allowed[pos % period])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[keep].view(np.int64)),
                        pa.array(keys[block.first + row[keep]]),
                        pa.array(pos[keep].astype(np.int32)),
                    ],
                    names=["h", "row", "pos"],
                )

    return emit


def _windows(length: int):
    period, _ = cover_for(length)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            anchors = batch.column(2)
            for block in word_blocks(batch.column(1)):
                hashes = block.hashes()
                other = mix(hashes + U64(1))
                out = []
                for i in range(block.rows):
                    at = anchors[block.first + i].values.to_numpy()
                    n = block.bounds[i + 1] - block.bounds[i] - length + 1
                    if n <= 0 or not len(at):
                        continue
                    edge = np.zeros(n + 1, dtype=np.int32)
                    np.add.at(edge, np.clip(at - period + 1, 0, n), 1)
                    np.add.at(edge, np.clip(at + 1, 0, n), -1)
                    starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    own = slice(block.bounds[i], block.bounds[i + 1])
                    out.append(
                        (
                            window_hashes(hashes[own], length)[starts].view(np.int64),
                            (window_hashes(other[own], length)[starts] >> U64(32)).astype(np.uint32).view(np.int32),
                            np.full(len(starts), keys[block.first + i]),
                            starts.astype(np.int32),
                        )
                    )
                if out:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "g", "row", "pos"])

    return emit


def _cutter(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.zeros((batch.num_rows, 2), dtype=np.int64)
        kept = []
        starts = batch.column(1)
        for i, text in enumerate(batch.column(0).field("text")):
            words = (text.as_py() or "").encode("utf-8").split()
            at = starts[i].values
            if at is not None and len(at):
                edge = np.zeros(len(words) + length + 1, dtype=np.int32)
                at = at.to_numpy()
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                stay = np.cumsum(edge)[: len(words)] == 0
                counts[i] = len(words), len(words) - stay.sum()
                words = [w for w, s in zip(words, stay, strict=True) if s]
            else:
                counts[i] = len(words), 0
            kept.append(b" ".join(words).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts[:, 0]), pa.array(counts[:, 1]), pa.array(kept, pa.string())],
            names=["rest", "n_words", "n_removed", "kept_text"],
        )


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).count().filter("count > 1").select(*keys)


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(row, starts): of each text with repeated windows, the words at which they start."""
    anchors = docs.select("row", "text").mapInArrow(_anchors(length), "h long, row long, pos int")
    shared = written(_repeated(anchors, "h"), "anchors")
    hits = anchors.join(shared, "h", "left_semi").groupBy("row").agg(F.collect_set("pos").alias("anchors"))
    hits = written(hits, "hits")
    windows = (
        docs.select("row", "text").join(hits, "row").select("row", "text", "anchors")
        .mapInArrow(_windows(length), "h long, g int, row long, pos int")
    )
    twice = written(_repeated(windows, "h", "g"), "windows")
    found = windows.join(twice, ["h", "g"], "left_semi").groupBy("row").agg(F.collect_set("pos").alias("starts"))
    return written(found, "repeated")


def without_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """The columns of `docs` with n_words, n_removed and kept_text (kept words, one blank between)."""
    carried = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text", whole_row(carried).alias("rest"))
    starts = repeated_windows(keyed, length)
    kind = with_rest(keyed, "n_words long, n_removed long, kept_text string")
    return (
        keyed.join(own_shuffle(starts, "row"), "row", "left")
        .select("rest", "starts")
        .mapInArrow(lambda batches: _cutter(batches, length), kind)
        .select("rest.*", "n_words", "n_removed", "kept_text")
    )
