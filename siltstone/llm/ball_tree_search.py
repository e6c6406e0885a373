"""Exact ranked search over sparse vectors by ball trees.

A document's vector holds, for each term of the items asked for, the integer
(10**9 * tf) div (1000 * tf + 8 * m), times the term's weight; an item's vector holds how
often it names each term. Their inner product is the score. Terms that no item names add
nothing, so only the items' terms are kept.

Vectors are dealt out by the term that weighs most in them, so that like ones meet. Each
task builds ball trees over up to `TREE` of them: a node is split by the nearer of two
far members until it holds `LEAF`, and keeps its centroid and radius. An item's inner
product with any member is at most that with the centroid plus the radius times the
item's length, taken over the terms that the node's members hold; the bound is rounded up
by more than its own error. An item goes through the nodes of a tree best bound first and
stops at a bound under its worst of the best so far, kept from tree to tree; scores at
the leaves are 64-bit integers. Every task hands on its best for each item, and the best
of those are the result.

Items are worked off in blocks of about `BLOCK_BYTES` of text, each with a pass over the
documents of its own, so what is sent to the tasks (the block's terms and items) does not
grow with the benchmark. Words are known by their 64-bit hashes and lengths.

Nulls: a null text has no terms. Rows without an id are documents; they come last among
equal scores and have a null doc_id. Rows that repeat an id are documents each; so are
items. An item without terms or matches has no rows. Empty tables give none.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.byte_spans import span_blocks
from siltstone.llm.common import per_process, written

BEST = 10
LENGTH_SHARE = 75
TREE, LEAF = 8192, 64
BLOCK_BYTES = 1 << 17
NO_ID = np.iinfo(np.int64).max

VECTORS = "id long, n long, terms array<int>, tfs array<int>"


def _term_bytes() -> np.ndarray:
    """0 for 0-9, A-Z, a-z and all above ASCII, else 1."""
    table = np.ones(256, dtype=np.uint8)
    for first, last in ((48, 57), (65, 90), (97, 122), (128, 255)):
        table[first : last + 1] = 0
    return table


_CLASSES = _term_bytes()


def _keys(spans) -> np.ndarray:
    return spans.hashes()[0] ^ (spans.ends - spans.starts).astype(np.uint64)


@dataclass
class Items:
    """Items of a block: sorted term keys, and (term, item, times) for each term of each item."""

    ids: list
    keys: np.ndarray
    term: np.ndarray
    item: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: pa.Array) -> Items:
        found, rows = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for spans in span_blocks(texts, _CLASSES, lower=True):
            found.append(_keys(spans))
            rows.append(spans.row_of() + spans.first)
        keys, which = np.unique(np.concatenate(found), return_inverse=True)
        pairs, times = np.unique(np.concatenate(rows) * len(keys) + which, return_counts=True)
        return cls(ids, keys, pairs % max(len(keys), 1), pairs // max(len(keys), 1), times)


def _vectorizer(sent):
    """(id, text) to VECTORS: terms in all, and the items' terms with their numbers."""

    def vectorize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value
        for batch in batches:
            for spans in span_blocks(batch.column(1), _CLASSES, lower=True):
                found = _keys(spans)
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == found)
                pairs, times = np.unique(spans.row_of()[hit] * len(keys) + at[hit], return_counts=True)
                bounds = pa.array(np.searchsorted(pairs, np.arange(spans.rows + 1) * len(keys)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(spans.first, spans.rows),
                        pa.array(np.diff(spans.bounds)),
                        pa.ListArray.from_arrays(bounds, pa.array((pairs % len(keys)).astype(np.int32))),
                        pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                    ],
                    names=["id", "n", "terms", "tfs"],
                )

    return vectorize


def _holders(size: int):
    """(term, df) of a task's vectors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "df"])

    return count


def impacts(tfs: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 8 m), with m = 100 - 75 + (75 n N) div L."""
    longest = int(lengths.max(initial=0))
    if LENGTH_SHARE * longest * documents < 1 << 62:
        m = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * documents // terms
    else:  # in whole numbers of any size
        m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(n) * documents // terms for n in lengths], dtype=np.int64)
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * m)


class Vectors:
    """Rows of weighted sparse vectors."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.bounds, self.terms, self.values = bounds, terms, values

    def take(self, rows: np.ndarray) -> Vectors:
        lengths = np.diff(self.bounds)[rows]
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[rows] - bounds[:-1], lengths)
        return Vectors(bounds, self.terms[at], self.values[at])

    def part(self, first: int, stop: int) -> Vectors:
        some = slice(self.bounds[first], self.bounds[stop])
        return Vectors(self.bounds[first : stop + 1] - self.bounds[first], self.terms[some], self.values[some])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, dtype=np.result_type(self.values, dense)), np.cumsum(self.values * dense[self.terms])))
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def squares(self) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(self.values.astype(np.float64) ** 2)))
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


class BallTree:
    """Rows in leaf order; nodes as (first, stop, children) with a bound for each item."""

    def __init__(self, vectors: Vectors, items: Items, leaf: int = LEAF):
        size = len(vectors.bounds) - 1
        self.order = np.arange(size)
        self.vectors, self.items = vectors, items
        self.nodes: list[tuple[int, int, tuple[int, int] | None]] = []
        self.count = len(items.ids)
        self.squared = items.times.astype(np.float64) ** 2
        self._bounds: list[np.ndarray] = []
        self._build(0, size, leaf)
        self.bounds = np.array(self._bounds)

    def _build(self, first: int, stop: int, leaf: int) -> int:
        own = self.vectors.part(first, stop)
        count = stop - first
        centroid = np.bincount(own.terms, own.values, len(self.items.keys)) / count
        squares, near = own.squares(), own.dot(centroid)
        middle = float(centroid @ centroid)
        largest = float(squares.max(initial=0)) + middle
        away = squares - 2 * near + middle
        # cancellation in `away` and rounding of the sums stay far below a billionth of the terms
        radius = math.sqrt(max(float(away.max()), 0.0) + 1e-9 * largest)
        means = centroid[self.items.term]
        product = np.bincount(self.items.item, means * self.items.times, self.count)
        lengths = np.sqrt(np.bincount(self.items.item, np.where(means > 0, self.squared, 0.0), self.count))
        at = len(self.nodes)
        self.nodes.append((first, stop, None))
        self._bounds.append((product + lengths * radius) * (1 + 1e-9) + 1)
        if count > leaf:
            sides = self._sides(own, squares, away)
            order = np.argsort(sides, kind="stable")
            nearer = int(np.searchsorted(sides[order], 0, side="right"))
            cut = first + min(max(nearer, count // 8), count - count // 8)  # both sides hold an eighth: few levels
            moved = own.take(order)
            some = slice(self.vectors.bounds[first], self.vectors.bounds[stop])
            self.vectors.terms[some], self.vectors.values[some] = moved.terms, moved.values
            self.vectors.bounds[first : stop + 1] = self.vectors.bounds[first] + moved.bounds
            self.order[first:stop] = self.order[first:stop][order]
            self.nodes[at] = (first, stop, (self._build(first, cut, leaf), self._build(cut, stop, leaf)))
        return at

    def _sides(self, own: Vectors, squares: np.ndarray, away: np.ndarray) -> np.ndarray:
        """Negative or zero for members nearer to the first of two far ones."""

        def distances(row: int) -> np.ndarray:
            one = own.part(row, row + 1)
            dense = np.zeros(len(self.items.keys))
            dense[one.terms] = one.values
            return squares - 2 * own.dot(dense) + squares[row]

        one = distances(int(away.argmax()))
        return one - distances(int(one.argmax()))


def search(tree: BallTree, ids: np.ndarray, item: int, asked: np.ndarray, best: list[tuple[int, int]], count: int) -> int:
    """Put the members that are among an item's best into its heap of (score, -id); the number of leaves looked into.

    `asked` holds the item's number of each term.
    """
    looked = 0
    due = [(-tree.bounds[0, item], 0)]
    while due:
        bound, node = heapq.heappop(due)
        if len(best) == count and -bound < best[0][0]:
            break
        first, stop, children = tree.nodes[node]
        if children:
            for child in children:
                heapq.heappush(due, (-tree.bounds[child, item], child))
            continue
        looked += 1
        scores = tree.vectors.part(first, stop).dot(asked)
        least = best[0][0] if len(best) == count else 1
        for at in np.flatnonzero(scores >= max(least, 1)):
            found = (int(scores[at]), -int(ids[tree.order[first + at]]))
            if len(best) < count:
                heapq.heappush(best, found)
            elif found > best[0]:
                heapq.heapreplace(best, found)
    return looked


def _searcher(sent, name: str, documents: int, terms: int, count: int):
    """VECTORS to (item, id, score): the best of a task's documents for each item."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TREE):
                part = batch.slice(at, TREE)
                if rows + part.num_rows > TREE:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = per_process(name, lambda: pickle.loads(sent.value))
        starts = np.searchsorted(items.item, np.arange(len(items.ids) + 1))
        best: list[list[tuple[int, int]]] = [[] for _ in items.ids]
        asked = np.zeros(len(items.keys), dtype=np.int64)
        for part in trees(batches):
            ids, lengths, which, tfs = (part.column(i).combine_chunks() for i in range(4))
            bounds = np.concatenate(([0], np.cumsum(which.value_lengths().to_numpy())))
            which = which.flatten().to_numpy().astype(np.int64)
            each = np.repeat(lengths.to_numpy(), np.diff(bounds))
            values = impacts(tfs.flatten().to_numpy().astype(np.int64), each, documents, terms) * weights[which]
            tree = BallTree(Vectors(bounds, which, values), items)
            ids = ids.fill_null(NO_ID).to_numpy()
            for item in range(len(best)):
                own = slice(starts[item], starts[item + 1])
                asked[items.term[own]] = items.times[own]
                search(tree, ids, item, asked, best[item], count)
                asked[items.term[own]] = 0
        rows = [(item, -found, score) for item, own in enumerate(best) for score, found in own]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "id", "score"])

    return find


def _placer(sent, name: str):
    """VECTORS with the term that weighs most in each, without the empty ones."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = per_process(name, lambda: pickle.loads(sent.value))[1]
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            batch = batch.filter(pa.array(lengths > 0))
            lengths = lengths[lengths > 0]
            which = batch.column(2).flatten().to_numpy()
            starts = np.cumsum(lengths) - lengths
            weighed = weights[which] * len(weights) + which
            heaviest = np.maximum.reduceat(weighed, starts) % len(weights) if len(starts) else weighed
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heaviest)], names=["id", "n", "terms", "tfs", "heaviest"])

    return place


def _ranked_block(texts: DataFrame, items: Items, count: int) -> DataFrame | None:
    """(item_id, rank, id, score): the best of each item of a block."""
    spark = texts.sparkSession
    keys = spark.sparkContext.broadcast(items.keys)
    vectors = written(texts.mapInArrow(_vectorizer(keys), VECTORS), "vectors")
    documents, terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not terms:
        return None
    df = np.zeros(len(items.keys), dtype=np.int64)
    holders = vectors.select("terms").mapInArrow(_holders(len(df)), "term int, df long")
    for term, found in holders.groupBy("term").agg(F.sum("df")).collect():  # one row for each of the block's terms
        df[term] = found
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
    asked = spark.sparkContext.broadcast(pickle.dumps((items, weights)))
    name = f"items {uuid.uuid4()}"
    placed = vectors.mapInArrow(_placer(asked, name), f"{VECTORS}, heaviest long")
    dealt = placed.repartitionByRange("heaviest", F.xxhash64("id", "n")).sortWithinPartitions("heaviest").drop("heaviest")
    found = dealt.mapInArrow(_searcher(asked, name, documents, terms, count), "item long, id long, score long")
    ids = spark.createDataFrame(list(enumerate(items.ids)), "item long, item_id long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= count)
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "id", "score")


def ranked(docs: DataFrame, items: DataFrame, count: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the `count` best documents of each item, by falling score and rising id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    asked = items.select(F.col("item_id").cast("long"), "text")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(total) // BLOCK_BYTES
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    parts = []
    for block in range(blocks):
        own = asked.filter(F.col("block") == block).select("item_id", "text").toArrow()  # about BLOCK_BYTES
        texts_of = own.column(1).combine_chunks() if own.num_rows else pa.array([], pa.string())
        held = Items.of(own.column(0).to_pylist(), texts_of)
        if len(held.keys):
            found = _ranked_block(texts, held, count)
            if found is not None:
                parts.append(found)
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows.select("item_id", "rank", F.when(F.col("id") < int(NO_ID), F.col("id")).alias("doc_id"), "score")
