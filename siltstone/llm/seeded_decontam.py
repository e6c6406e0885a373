"""Benchmark passages in documents, by spaced seeds. DataFrame functions only.

Tokens are longest runs of letters and digits, lower-cased, known by 64-bit hashes.
Each mask of MASKS picks token positions relative to a start; the tokens picked are
hashed, those between are ignored, so a substituted token leaves the seeds intact
that pass over it. Seeds of the items are joined with those of all documents. Around
each hit item and document are aligned, and the overlap counts if some stretch of
`overlap` tokens (the whole item if shorter) agrees in at least `percent` of them.

An item with fewer tokens than the shortest mask spans has one seed, all its tokens, and is
found where they stand word for word; `least_tokens` leaves out items that are shorter
still (by default none). Null and empty texts have no tokens. A hit is reported once for each document id and
item, however often it or the rows repeat. Only the columns named here are read.

The items' seeds are sent to all tasks while there are at most `broadcast_rows`, and
joined by shuffle beyond that. What was hit (few rows) is joined with the documents
again for the verification, so no token list is copied for each of its positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, written

# Positions that a mask keeps.
MASKS = ((0, 1, 2, 5, 7, 8), (0, 1, 3, 6, 10, 11), (0, 2, 3, 8, 9, 12))
OVERLAP = 13
PERCENT = 80
BROADCAST_ROWS = 200_000
SHORTEST = min(mask[-1] for mask in MASKS) + 1


def _tokens(text: str) -> Column:
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(words, lambda w: F.when(w != "", F.xxhash64(w)))


def _seeds(tokens: Column, at: Column) -> Column:
    """Seed of each mask at a position; null where a token is missing."""
    found = []
    for number, mask in enumerate(MASKS):
        picked = [F.get(tokens, at + F.lit(p)) for p in mask]
        whole = F.get(tokens, at).isNotNull() & F.get(tokens, at + F.lit(mask[-1])).isNotNull()
        found.append(F.when(whole, F.xxhash64(F.lit(number), *picked)))
    return F.array(*found)


def _whole(tokens: Column, at: Column, length: int) -> Column:
    """Seed of `length` tokens in a row; null where one is missing."""
    picked = [F.get(tokens, at + F.lit(i)) for i in range(length)]
    return F.when(picked[0].isNotNull() & picked[-1].isNotNull(), F.xxhash64(F.lit(-length), *picked))


def _short_hits(tokens: DataFrame, tested: DataFrame) -> DataFrame | None:
    """(row, item_id, shift): the first place of each item under SHORTEST tokens in each text, if there are such items."""
    short = written(tested.filter(F.size("tokens").between(1, SHORTEST - 1)), "short")
    lengths = sorted(r[0] for r in short.select(F.size("tokens")).distinct().collect())  # under SHORTEST
    if not lengths:
        return None
    at = F.col("at")
    asked = F.coalesce(*[F.when(F.size("tokens") == n, _whole(F.col("tokens"), F.lit(0), n)) for n in lengths])
    items = short.select("item_id", asked.alias("seed"))
    starts = tokens.select("row", "tokens", F.posexplode_outer("tokens").alias("at", "_token"))
    seeds = F.array(*[_whole(F.col("tokens"), at, n) for n in lengths])
    found = starts.select("row", "at", F.explode(seeds).alias("seed")).filter("seed is not null")
    # each seed of a text once, with its first place, before it meets the items
    first = found.groupBy("row", "seed").agg(F.min("at").alias("shift"))
    return first.join(items, "seed").select("row", "item_id", "shift")


def _start_seeds(rows: DataFrame, key: str) -> DataFrame:
    """(key, at, seed): one row for each seed, with the position it starts at."""
    # the outer forms keep the optimizer from working `tokens` out once more in a filter
    starts = rows.select(key, "tokens", F.posexplode_outer("tokens").alias("at", "_token"))
    return starts.select(key, "at", F.explode(_seeds(F.col("tokens"), F.col("at"))).alias("seed")).filter("seed is not null")


def _agrees(overlap: int, percent: int) -> Column:
    """Whether item and document agree when the item begins at document token `shift`."""
    shift, item, tokens = F.col("shift"), F.col("item_tokens"), F.col("tokens")
    first = F.greatest(F.lit(0), -shift)
    last = F.least(F.size(item), F.size(tokens) - shift) - 1
    same = F.transform(
        F.sequence(first, last), lambda q: F.when(F.get(item, q) == F.get(tokens, q + shift), 1).otherwise(0)
    )
    span = F.least(F.lit(overlap), F.size(item))
    sums = F.transform(
        F.sequence(F.lit(1), F.size(same) - span + 1),
        lambda at: F.aggregate(F.slice(same, at, span), F.lit(0), lambda total, x: total + x),
    )
    return (last - first + 1 >= span) & (F.array_max(sums) * 100 >= span * percent)


def _row() -> Column:
    """A row's key, of 128 bits; equal rows share it."""
    return F.struct(F.xxhash64("doc_id", "text"), F.xxhash64(F.lit("row"), "doc_id", "text"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    overlap: int = OVERLAP,
    percent: int = PERCENT,
    broadcast_rows: int = BROADCAST_ROWS,
    least_tokens: int = 1,
) -> DataFrame:
    """(doc_id, item_id) of every document that holds a passage of an item."""
    tested = items.select("item_id", F.filter(_tokens("text"), lambda t: t.isNotNull()).alias("tokens"))
    tested = tested.filter(F.col("item_id").isNotNull() & (F.size("tokens") >= least_tokens))
    seeds = _start_seeds(tested, "item_id").withColumnRenamed("at", "item_at")
    if seeds.count() <= broadcast_rows:
        seeds = F.broadcast(seeds)
    keyed = docs.filter("doc_id is not null and text is not null").select("doc_id", _row().alias("row"), "text")
    tokens = keyed.select("row", _tokens("text").alias("tokens"))
    found = _start_seeds(tokens, "row").join(seeds, "seed").select("row", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    found = found.distinct()
    short = _short_hits(tokens, tested)
    found = written(found if short is None else found.union(short), "seeded")
    texts = written(keyed.join(own_shuffle(found.select("row").distinct(), "row"), "row", "left_semi"), "texts")
    aligned = found.join(tested.select("item_id", F.col("tokens").alias("item_tokens")), "item_id")
    hits = texts.select("doc_id", "row", _tokens("text").alias("tokens")).join(aligned, "row")
    return hits.filter(_agrees(overlap, percent)).select("doc_id", "item_id").distinct()
