"""Phrase collocations by prefix-free parsing.

Texts are lower-cased (A-Z), split into pieces at punctuation and line breaks, and into
words at blanks. Each text's words are parsed into chunks: a chunk ends where the hash
of its last two words hits a trigger, so equal passages are cut alike wherever they
stand, and the next chunk begins with the last `longest - 1` words of the one before.
The dictionary holds each distinct chunk of a language once, with its frequency. A
phrase is counted in the chunk that holds its last word past the words taken over, once
for each distinct chunk and weighted by the frequency; so each occurrence counts once,
and copies cost nothing.

Phrases of one more word are counted only where both phrases of one word less inside
them are frequent, as no other can be. The test is a bit table of bounded size, made
from the frequent phrases: it lets some others through, which the exact counts, by the
words themselves, then drop. All counting is by language and phrase with partial sums in
each task, so a language or a phrase with a third of all rows is not one task's.

A chunk is cut at `LONGEST_CHUNK` words where no trigger comes; counts do not depend on
where chunks are cut. A null text has no words; a null language is `und`. Rows that repeat
are counted each. Ids and further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.byte_spans import byte_classes, chained, slices, span_blocks
from siltstone.llm.common import own_shuffle, per_process, written
from siltstone.llm.wordhash import U64, mix

LONGEST, LEAST, COVER, FIRST = 3, 10, 50, 2000
TRIGGER = 24
LONGEST_CHUNK = 512
FILTER_BITS = (20, 28)
SCALE = 1_000_000

_TEXT = byte_classes(blank=b" \t", stop=b".,;:!?\n\x0b\x0c\r")
_CHUNK = byte_classes(blank=b" ", stop=b"\n")
_STOP = 2


def _breaks(spans, rows: np.ndarray) -> np.ndarray:
    """For each word, how many gaps before it hold a stop or the end of a row."""
    stops = np.concatenate(([0], np.cumsum(spans.classes == _STOP)))
    gap = np.zeros(len(rows), dtype=np.int64)
    gap[1:] = (stops[spans.starts[1:]] > stops[spans.ends[:-1]]) | (rows[1:] != rows[:-1])
    return np.cumsum(gap)


def _parser(overlap: int):
    """(lang, text) to chunks; words joined by one blank, or a line break where a piece ends."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for spans in span_blocks(batch.column(1), _TEXT, lower=True):
                words = len(spans.starts)
                if not words:
                    continue
                rows = spans.row_of()
                breaks = _breaks(spans, rows)
                lengths = spans.ends - spans.starts
                at = np.concatenate(([0], np.cumsum(lengths + 1)))
                plain = np.full(at[-1], 32, dtype=np.uint8)
                plain[at[1:-1][np.diff(breaks) > 0] - 1] = 10
                inside = np.flatnonzero(spans.classes == 0)
                plain[np.arange(len(inside)) + np.repeat(np.arange(words), lengths)] = spans.data[inside]

                first = spans.bounds[rows]
                h = spans.hashes()[0]
                cut = np.zeros(words, dtype=bool)
                cut[1:] = (chained([h[:-1], h[1:]], 1) % U64(TRIGGER) == 0) & (rows[1:] == rows[:-1])
                cut[spans.bounds[1:][np.diff(spans.bounds) > 0] - 1] = True
                since = np.arange(words) - np.maximum.accumulate(np.where(cut, np.arange(words), -1))
                cut |= (since > 0) & (since % LONGEST_CHUNK == 0)
                last = np.flatnonzero(cut)
                before = np.concatenate(([-1], last[:-1]))  # the word that the chunk before ends with
                opens = before < first[last]
                begin = np.where(opens, first[last], np.maximum(before - overlap + 1, first[last]))
                skip = np.where(opens, 0, before - begin + 1)
                row = pa.array(rows[last] + spans.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        pa.array(skip.astype(np.int8)),
                        pa.array((last - begin + 1 - skip).astype(np.int32)),
                        slices(plain, at[begin], at[last + 1] - 1).cast(pa.string()),
                    ],
                    names=["lang", "skip", "words", "chunk"],
                )

    return parse


def dictionary(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, skip, words, chunk, n): distinct chunks, the words taken over and own, and how often each occurs."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text is not null")
    chunks = rows.mapInArrow(_parser(longest - 1), "lang string, skip byte, words int, chunk string")
    return chunks.groupBy("lang", "skip", "words", "chunk").agg(F.count("*").alias("n"))


def _joined(batches: Iterator[pa.RecordBatch], size: int = 1 << 22) -> Iterator[pa.Table]:
    """Batches put together to about `size` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class _Grams:
    """Phrases of the chunks of a block, known by the index of their last word."""

    def __init__(self, spans, langs: pa.Array):
        self.spans = spans
        self.rows = spans.row_of()
        self.breaks = _breaks(spans, self.rows)
        coded = langs.dictionary_encode()
        names = pa.array(coded.dictionary, pa.string())
        of_lang = np.zeros(len(names), dtype=np.uint64)
        for block in span_blocks(names, np.zeros(256, dtype=np.uint8)):
            some = np.flatnonzero(np.diff(block.bounds))
            of_lang[some + block.first] = block.hashes()[0]
        self.lang = of_lang[coded.indices.to_numpy()][self.rows]
        self.h = spans.hashes()

    def ends(self, size: int) -> np.ndarray:
        """Last words of the phrases of `size` words."""
        last = np.arange(size - 1, len(self.rows))
        return last[self.breaks[last] == self.breaks[last - size + 1]]

    def hash(self, last: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        return chained([self.lang[last], *(self.h[which][last - i] for i in range(size))], size)


def _slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(hashes ^ U64(salt)) >> U64(64 - bits)).astype(np.int64) for salt in (0x51, 0xA7)]


def _counter(size: int, sent, bits: int, name: str):
    """Phrases of `size` words of dictionary rows (lang, skip, chunk, n), each once for a block."""

    def held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for slot in _slots(hashes, bits):
            found &= (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return found

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _joined(batches):
            langs, skips, chunks, n = (part.column(i).combine_chunks() for i in range(4))
            skips, n = skips.to_numpy(), n.to_numpy()
            for spans in span_blocks(chunks, _CHUNK):
                own = langs.slice(spans.first, spans.rows)
                grams = _Grams(spans, own)
                last = grams.ends(size)
                row = grams.rows[last]
                last = last[last - spans.bounds[row] >= skips[spans.first + row]]
                if size > 1:
                    table = per_process(name, lambda: np.frombuffer(sent.value, dtype=np.uint8))
                    last = last[held(table, grams.hash(last, size - 1))]
                    last = last[held(table, grams.hash(last - 1, size - 1))]
                if not len(last):
                    continue
                one, two = (grams.hash(last, size, which) for which in (0, 1))
                order = np.argsort(one)
                new = np.ones(len(last), dtype=bool)
                new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
                heads = np.flatnonzero(new)
                sums = np.add.reduceat(n[spans.first + grams.rows[last[order]]], heads)
                shown = last[order[heads]]
                yield pa.RecordBatch.from_arrays(
                    [
                        own.take(pa.array(grams.rows[shown])),
                        slices(spans.data, spans.starts[shown - size + 1], spans.ends[shown]).cast(pa.string()),
                        pa.array(sums),
                    ],
                    names=["lang", "phrase", "f"],
                )

    return count


def _slot_finder(size: int, bits: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _joined(batches):
            langs, phrases = (part.column(i).combine_chunks() for i in (0, 1))
            for spans in span_blocks(phrases, _CHUNK):
                grams = _Grams(spans, langs.slice(spans.first, spans.rows))
                slots = np.unique(np.concatenate(_slots(grams.hash(grams.ends(size), size), bits)))
                heads = np.flatnonzero(np.diff(slots >> 6, prepend=-1))
                words = np.bitwise_or.reduceat(U64(1) << (slots & 63).astype(np.uint64), heads) if len(slots) else slots.view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(slots[heads] >> 6), pa.array(words.view(np.int64))], names=["at", "bits"])

    return find


def _bit_table(frequent: DataFrame, size: int) -> tuple[bytes, int]:
    """Two bits for each phrase, in a table of at least sixteen for each up to 2**FILTER_BITS[1] (32 MB)."""
    bits = min(max((16 * frequent.count()).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    found = frequent.select("lang", "phrase").mapInArrow(_slot_finder(size, bits), "at long, bits long")
    found = found.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # bounded by the table
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table.tobytes(), bits


def phrase_counts(chunks: DataFrame, longest: int, least: int) -> list[DataFrame]:
    """For each length up to `longest`, (lang, phrase, f) of all phrases with f >= least."""
    rows = chunks.select("lang", "skip", "chunk", "n")
    found: list[DataFrame] = []
    sent, bits = None, 0
    for size in range(1, longest + 1):
        if found:
            table, bits = _bit_table(found[-1], size - 1)
            sent = chunks.sparkSession.sparkContext.broadcast(table)
        counter = _counter(size, sent, bits, f"phrases {id(sent)} {size}")
        counts = rows.mapInArrow(counter, "lang string, phrase string, f long")
        counts = counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        found.append(written(counts.filter(F.col("f") >= least), f"phrases{size}"))
    return found


def _part(words: Column, first: int, count: int) -> Column:
    return F.array_join(F.slice(words, first + 1, count), " ")


def _scored(size: int, counts: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of `size` words, by their lowest cut."""
    words = F.split("phrase", " ")
    rows = counts[size - 1].withColumnRenamed("f", "a")
    cuts = []
    for k in range(1, size):
        for side, first, count in ((f"l{k}", 0, k), (f"r{k}", k, size - k)):
            part = counts[count - 1].select("lang", F.col("phrase").alias("part"), F.col("f").alias(side))
            keyed = rows.withColumn("part", _part(words, first, count))
            rows = keyed.join(own_shuffle(part, "lang", "part"), ["lang", "part"]).drop("part")
        big = {c: F.col(c).cast("decimal(19,0)") for c in ("a", f"l{k}", f"r{k}")}
        score = F.call_function("div", big["a"] * big["a"] * F.lit(SCALE).cast("decimal(10,0)"), big[f"l{k}"] * big[f"r{k}"])
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    lowest = F.array_min(F.array(*cuts)).alias("cut")
    return rows.select("lang", "phrase", "a", lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cover: int = COVER, first: int = FIRST
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to `longest` words.

    a, l, r are the frequencies of the phrase and of its two parts, n the language's words.
    The score is floor(10**6 * a * a / (l * r)) at the cut where it is lowest. Phrases
    inside a longer one with at least `cover` percent of their frequency are left out.
    """
    chunks = written(dictionary(docs, longest), "dictionary")
    counts = phrase_counts(chunks, longest, least)
    parts = []
    for size in range(2, longest + 1):
        rows = _scored(size, counts)
        inside = None
        for longer in range(size + 1, longest + 1):
            words = F.split("phrase", " ")
            subs = F.array(*[_part(words, i, size) for i in range(longer - size + 1)])
            held = counts[longer - 1].select("lang", F.explode(F.array_distinct(subs)).alias("phrase"), "f")
            inside = held if inside is None else inside.union(held)
        if inside is not None:
            most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
            rows = rows.join(own_shuffle(most, "lang", "phrase"), ["lang", "phrase"], "left")
            share = F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * cover
            rows = rows.filter(~F.coalesce(share, F.lit(False))).drop("most")
        parts.append(rows)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= first)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("words")).alias("n"))
    return top.join(own_shuffle(totals, "lang"), "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )
