"""Quality filter: interpolated modified Kneser-Ney model, perplexity, language quantiles.

The model's units are characters, folded to 4096 codes (those under U+0800 as they
are), in n-grams of ORDER that start with the begin of the text. Word n-grams of
web text are nearly as many as words, so a row for each would move several times
the input; character n-grams repeat, and tasks send each distinct one once.

Counts come from all trusted texts but a held-out fifth. Every n-gram code found in
any text is then joined with its count, with its context's totals and with the next
lower order, which holds the continuation counts; discounts are those of each order.
All these joins are sharded by language and code. Documents are scored with the
resulting table: sent to all tasks while it holds at most `broadcast_rows`, and
joined chunk by chunk beyond that. Thresholds are quantiles of the perplexity of the
held-out trusted texts of each language; a language without any keeps all.

A null or empty text has no perplexity and is kept, as nothing speaks against it. A
null language is a language of its own. Rows that repeat are scored each. Columns of
`docs` are carried along unless named like one of the new columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.llm.common import own_shuffle, quoted, whole_row, with_rest, written

ORDER = 5
BITS = 12
UNITS = 1 << BITS
QUANTILE = 0.995
NO_LANG = "\x00"
BROADCAST_ROWS = 4_000_000
BROADCAST_IDS = 1_000_000
CHUNK_CHARS = 1 << 23
BLOCK_CHARS = 1 << 19

KEY = ["lang", "code"]


def codes(text: str) -> np.ndarray:
    """One code for each character: it and the ORDER - 1 before it (0 before the text)."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    units = np.where(points < 2048, points, 2048 + points * 2654435761 % 2039)
    padded = np.concatenate((np.zeros(ORDER - 1, dtype=np.int64), units))
    total = np.zeros(len(units), dtype=np.int64)
    for i in range(ORDER):
        total = (total << BITS) | padded[i : i + len(units)]
    return total


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BLOCK_CHARS characters."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= BLOCK_CHARS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


class _Tally:
    """Distinct codes and their counts by language, merged block by block."""

    def __init__(self):
        self.held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def add(self, langs: list[str], texts: list[str | None]) -> None:
        for first, stop in _blocks(texts):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(langs[first:stop], texts[first:stop], strict=True):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, group in by_lang.items():
                found = np.unique(np.concatenate([codes(t) for t in group]), return_counts=True)
                self.held.setdefault(lang, []).append(found)
                if len(self.held[lang]) > 8:
                    self.held[lang] = [self._merged(lang)]

    def _merged(self, lang: str) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(c) for c in zip(*self.held[lang], strict=True))
        distinct, where = np.unique(keys, return_inverse=True)
        return distinct, np.bincount(where, counts, len(distinct)).astype(np.int64)

    def batches(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        for lang in self.held:
            yield lang, *self._merged(lang)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of the rows (lang, text) of a task."""
    tally = _Tally()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            tally.add(part.column(0).to_pylist(), part.column(1).to_pylist())
    for lang, keys, counts in tally.batches():
        for at in range(0, len(keys), 50_000):
            some = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys[some]), pa.string()), pa.array(keys[some]), pa.array(counts[some])],
                names=["lang", "code", "n"],
            )


def code_counts(rows: DataFrame) -> DataFrame:
    """Counts of all codes of rows (lang, text)."""
    found = rows.select("lang", "text").mapInArrow(_counter, "lang string, code long, n long")
    return found.groupBy(KEY).agg(F.sum("n").alias("c"))


def _suffix(order: int):
    return F.col("code").bitwiseAND((1 << (BITS * order)) - 1)


def _prefix():
    return F.shiftright("code", BITS)


def discounts(tables: dict[int, DataFrame]) -> dict[int, tuple[float, float, float]]:
    """D1, D2, D3+ of each order from its counts of counts."""
    parts = [t.select(F.lit(k).alias("k"), "c") for k, t in tables.items()]
    found = (
        reduce(DataFrame.union, parts).filter("c <= 4").groupBy("k")
        .agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()
    )
    out = {k: (0.5, 0.75, 0.9) for k in tables}
    for row in found:
        n1, n2, n3, n4 = (row[f"n{i}"] for i in (1, 2, 3, 4))
        if n1 and n2 and n3:
            y = n1 / (n1 + 2 * n2)
            d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            out[row["k"]] = tuple(min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1))
    return out


def scored_codes(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lang, code, score): log probability of each wanted code's last unit."""
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        lower = tables[k + 1].select("lang", _suffix(k).alias("code"))
        tables[k] = written(lower.groupBy(KEY).agg(F.count("*").alias("c")), f"order{k}")
    cut = discounts(tables)

    asked = {ORDER: wanted}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = written(asked[k + 1].select("lang", _suffix(k).alias("code")).distinct(), f"asked{k}")

    below = None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = (F.lit(d) for d in cut[k])
        c = F.col("c")
        contexts = tables[k].groupBy("lang", _prefix().alias("context")).agg(
            F.sum("c").alias("total"),
            (d1 * F.count_if(c == 1) + d2 * F.count_if(c == 2) + d3 * F.count_if(c >= 3)).alias("left"),
        )
        cutoff = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        rows = (
            asked[k].join(tables[k], KEY, "left")
            .withColumns({"context": _prefix(), "suffix": _suffix(k - 1)})
            .join(contexts, ["lang", "context"], "left")
        )
        if below is None:
            rows = rows.withColumn("lower", F.lit(1.0 / UNITS))
        else:
            rows = rows.join(below.select("lang", F.col("code").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        p = F.coalesce((c - cutoff) / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("left") / F.col("total"), F.lit(1.0)) * F.col("lower")
        below = written(rows.select("lang", "code", p.alias("p")), f"p{k}")
    return below.select("lang", "code", F.log("p").alias("score"))


def _by_lang(table: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted codes and their scores of each language."""
    found = {}
    langs = table.column("lang").combine_chunks().dictionary_encode()
    which = langs.indices.to_numpy()
    keys, scores = table.column("code").to_numpy(), table.column("score").to_numpy()
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        own = np.flatnonzero(which == i)
        own = own[np.argsort(keys[own])]
        found[lang] = keys[own], scores[own].astype(np.float32)
    return found


class _Scores:
    def __init__(self, by_lang: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.by_lang = by_lang

    def perplexities(self, langs: list[str], texts: list[str | None]) -> list[float | None]:
        out: list[float | None] = [None] * len(texts)
        for first, stop in _blocks(texts):
            for lang in set(langs[first:stop]):
                own = [i for i in range(first, stop) if langs[i] == lang and texts[i]]
                if not own:
                    continue
                keys, scores = self.by_lang[lang]
                each = [codes(texts[i]) for i in own]
                distinct, where = np.unique(np.concatenate(each), return_inverse=True)
                values = scores[np.searchsorted(keys, distinct)].astype(np.float64)[where]
                lengths = np.array([len(e) for e in each])
                sums = np.add.reduceat(values, np.concatenate(([0], np.cumsum(lengths)[:-1])))
                for i, x in zip(own, np.exp(-sums / lengths), strict=True):
                    out[i] = float(x)
        return out


def _with_perplexity(rest: pa.Array, scores: _Scores, langs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    found = pa.array(scores.perplexities(langs.to_pylist(), texts.to_pylist()), pa.float64())
    return pa.RecordBatch.from_arrays([rest, found], names=["rest", "perplexity"])


def _scored_here(sent):
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scores = _Scores(sent.value)
        for langs, texts in batches:
            found = []
            for at in range(0, len(texts), 500):
                found += scores.perplexities(langs.slice(at, 500).to_pylist(), texts.slice(at, 500).to_pylist())
            yield pa.array(found, pa.float64())

    return score


def _scored_by_chunk(rows: DataFrame, scores: DataFrame, schema: StructType) -> DataFrame:
    """Texts and the scores of their codes meet chunk by chunk; rows are dealt by number, so equal texts spread."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = 1 + chars // CHUNK_CHARS
    placed = written(rows.withColumn("chunk", F.pmod(F.monotonically_increasing_id(), F.lit(chunks))), "placed")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in np.unique(batch.column(0).to_numpy()):
                own = batch.filter(pa.compute.equal(batch.column(0), chunk))
                for found in _counter(iter([own.select([1, 2])])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(found.num_rows, chunk)), found.column(0), found.column(1)], names=["chunk", "lang", "code"]
                    )

    asked = placed.select("chunk", "lang", "text").mapInArrow(collect, "chunk long, lang string, code long").distinct()
    answers = asked.join(scores, KEY)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"rest": left.column("rest"), "perplexity": pa.array([], pa.float64())})
        columns = (left.column(c).combine_chunks() for c in ("lang", "text"))
        part = _with_perplexity(left.column("rest").combine_chunks(), _Scores(_by_lang(right)), *columns)
        return pa.Table.from_batches([part])

    return placed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def _ids(trusted: DataFrame) -> DataFrame:
    """Distinct ids, sent to all tasks while they are few, so that texts need no shuffle."""
    ids = trusted.select("doc_id").filter("doc_id is not null").distinct()
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else own_shuffle(ids, "doc_id")


def perplexities(docs: DataFrame, trusted: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The columns of `docs` with the perplexity under the trusted texts' model."""
    lang = _lang()
    texts = docs.select("doc_id", lang.alias("lang"), "text")
    taught = texts.join(_ids(trusted), "doc_id", "left_semi")
    counts = written(code_counts(taught.filter(~held_out())), "counts")
    wanted = written(code_counts(texts).select(KEY), "codes")
    scores = written(scored_codes(counts, wanted), "scores")

    if scores.count() > broadcast_rows:
        rows = docs.select(whole_row(docs.columns).alias("rest"), lang.alias("lang"), "text")
        return _scored_by_chunk(rows, scores, with_rest(rows, "perplexity double")).select("rest.*", "perplexity")
    sent = docs.sparkSession.sparkContext.broadcast(_by_lang(scores.toArrow()))
    score = F.arrow_udf(_scored_here(sent), "double")  # the texts alone go to Python, and none comes back
    return docs.select(*map(quoted, docs.columns), score(lang, "text").alias("perplexity"))


def _lang():
    """The language, with a name of its own for null."""
    return F.coalesce(F.col("lang"), F.lit(NO_LANG))


def held_out():
    """A fifth of the ids, which the model does not see."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def quality(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The columns of `docs` with perplexity, threshold and kept."""
    carried = [c for c in docs.columns if c not in ("perplexity", "threshold", "kept")]
    scored = written(perplexities(docs.select(*map(quoted, carried)), trusted, broadcast_rows), "perplexities")
    fields = scored.select("doc_id", _lang().alias("lang"), "perplexity")
    known = fields.filter(held_out() & F.col("perplexity").isNotNull()).join(
        _ids(trusted), "doc_id", "left_semi"
    )
    thresholds = known.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    thresholds = written(thresholds.withColumnRenamed("lang", "_lang"), "thresholds")
    if thresholds.count() <= 10_000:  # one row for each language
        thresholds = F.broadcast(thresholds)
    rows = scored.join(thresholds, _lang() == F.col("_lang"), "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return rows.select(*map(quoted, carried), "perplexity", "threshold", kept.alias("kept"))
