"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of word shingles. Equal sets are one class, with a number and the
smallest id that has it. Classes whose signatures agree in a whole band
meet in a bucket. A pair from a bucket compares its signatures batch by batch and
is dropped once the posterior probability of reaching the threshold (uniform prior)
falls under `miss`; what is left is confirmed on the full shingle sets.

Buckets never emit all their pairs. In a bucket every member is first compared
with the smallest one, and links found become components. A bucket whose members
lie in one component is done. In the others a member drawn from the largest
component is compared with all outside that component, in rounds that each cost one
row per open member, for as long as a round at least halves the outsiders. What is
left is worked off whole: blocks of about `BLOCK` outsiders meet blocks of as many
members inside tasks, which pass on links only. A pair that meets in several
buckets is compared there in the first of them. No pair that shares a bucket and is
not known to be connected is left out.

Nulls: a null text has no shingles, as an empty one, and links with nothing. A row
with a null id is kept as a component of its own with null component_id. Rows that
repeat an id are one node: the classes of all its texts are linked. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, written
from siltstone.llm.graph import components
from siltstone.llm.wordhash import U64, mix, shingle_set, word_blocks

BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
MISS = 1e-4
BLOCK = 128

_SEEDS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, (2, HASHES), dtype=np.uint64)
_XOR, _FACTOR = _SEEDS[0] * U64(2), _SEEDS[1] * U64(2) + U64(1)

SIGNED = "doc_id long, tag long, n_shingles long, print binary, sig binary, bands array<long>"


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value under each of HASHES hash functions, 32 bits each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        part = (shingles[at : at + 2048, None] ^ _XOR) * _FACTOR
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> U64(32)).astype(np.uint32)


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band's number is in it."""
    parts = sigs.reshape(len(sigs), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sigs), BANDS)).copy()
    for i in range(ROWS):
        keys = mix(keys * U64(0x9FB21C651E98DF25) + parts[:, :, i])
    return keys.view(np.int64)


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column(2), lower=True):
                hashes = block.hashes()
                counts = np.zeros(block.rows, dtype=np.int64)
                prints: list[bytes | None] = [None] * block.rows
                sigs = np.zeros((block.rows, HASHES), dtype=np.uint32)
                for i in range(block.rows):
                    shingles = shingle_set(hashes[block.bounds[i] : block.bounds[i + 1]], size)
                    counts[i] = len(shingles)
                    if len(shingles):
                        prints[i] = xxhash.xxh3_128_digest(shingles.tobytes())
                        sigs[i] = signature(shingles)
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (block.rows + 1) * BANDS, BANDS, dtype=np.int32)),
                    pa.array(band_keys(sigs).reshape(-1)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(block.first, block.rows) for i in (0, 1)),
                        pa.array(counts),
                        pa.array(prints, pa.binary()),
                        pa.array([s.tobytes() for s in sigs], pa.binary()),
                        keys,
                    ],
                    names=["doc_id", "tag", "n_shingles", "print", "sig", "bands"],
                )

    return sign


def posterior(matches: int, seen: int, threshold: float) -> float:
    """P(similarity >= threshold | matches of seen hashes agree), prior uniform on 0..1."""
    n = seen + 1
    return sum(comb(n, j) * threshold**j * (1 - threshold) ** (n - j) for j in range(matches + 1))


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes seen, matches below which a pair is dropped) after each batch of ROWS * 5."""
    steps = []
    batches = range(ROWS * 5, HASHES + 1, ROWS * 5)
    for seen in batches:  # each may drop a pair: `miss` is shared among them
        need = next(m for m in range(seen + 1) if posterior(m, seen, threshold) >= miss / len(batches))
        steps.append((seen, need))
    return steps


def survivors(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Rows of two signature matrices that no batch of hashes rules out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int64)
    done = 0
    for seen, need in steps:
        matches[alive] += (left[alive, done:seen] == right[alive, done:seen]).sum(axis=1)
        alive = alive[matches[alive] >= need]
        done = seen
    return alive


def _signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared)


def _pruner(threshold: float, miss: float):
    steps = least_matches(threshold, miss)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = survivors(_signatures(batch.column(2)), _signatures(batch.column(3)), steps)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], names=["a", "b"])

    return prune


def _confirmer(size: int, percent: int):
    def sets(texts: pa.Array) -> list[np.ndarray]:
        """Shingle sets of a column; equal neighbours, as of one pivot, are worked out once."""
        runs = pc.run_end_encode(texts)
        found = []
        for block in word_blocks(runs.values, lower=True):
            hashes = block.hashes()
            found += [shingle_set(hashes[block.bounds[i] : block.bounds[i + 1]], size) for i in range(block.rows)]
        lengths = np.diff(runs.run_ends.to_numpy(), prepend=0)
        return [s for s, n in zip(found, lengths, strict=True) for _ in range(n)]

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keep = [similar(x, y, percent) for x, y in zip(sets(part.column(2)), sets(part.column(3)), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"]
                )

    return confirm


def verified(pairs: DataFrame, faces: DataFrame, size: int, percent: int, miss: float) -> DataFrame:
    """Of pairs (a, b) of representatives those that are similar enough."""

    def with_both(pairs: DataFrame, column: str) -> DataFrame:
        face = faces.select("id", column)
        return (
            pairs.join(face.withColumnsRenamed({"id": "b", column: "of_b"}), "b")
            .join(face.withColumnsRenamed({"id": "a", column: "of_a"}), "a")
            .select("a", "b", "of_a", "of_b")
        )

    likely = written(with_both(pairs, "sig").mapInArrow(_pruner(percent / 100, miss), "a long, b long"), "likely")
    return written(with_both(likely, "text").mapInArrow(_confirmer(size, percent), "a long, b long"), "confirmed")


def _block_comparer(size: int, percent: int, miss: float):
    """Links of a block of outsiders of a bucket with a block of its members."""
    steps = least_matches(percent / 100, miss)

    def compare(unit: pa.Table) -> pa.Table:
        ids, component, asks, outside = (unit.column(c).to_numpy() for c in ("id", "component", "asks", "outside"))
        band = unit.column("band")[0].as_py()
        sigs = _signatures(unit.column("sig"))
        keys = band_keys(sigs)
        texts = unit.column("text")
        held: dict[int, np.ndarray] = {}

        def shingles(i: int) -> np.ndarray:
            if i not in held:
                part = next(word_blocks(pa.array([texts[i].as_py()], pa.string()), lower=True))
                held[i] = shingle_set(part.hashes(), size)
            return held[i]

        now = component.copy()  # links found here join components for the rest of the unit
        found = []
        for i in np.flatnonzero(asks):
            other = np.flatnonzero(~asks & (now != now[i]) & (~outside | (ids > ids[i])))
            other = other[~(keys[other, :band] == keys[i, :band]).any(axis=1)]
            other = other[survivors(np.broadcast_to(sigs[i], (len(other), HASHES)), sigs[other], steps)]
            for j in other[np.argsort(-(sigs[other] == sigs[i]).sum(axis=1), kind="stable")]:
                if now[i] != now[j] and similar(shingles(i), shingles(j), percent):
                    found.append((ids[i], ids[j]))
                    now[now == now[j]] = now[i]
        a, b = (np.array([f[k] for f in found], dtype=np.int64) for k in (0, 1))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return compare


def _open_buckets(members: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Members with their components, and the buckets that hold more than one component."""
    component = F.coalesce("component", "id").alias("component")
    tagged = written(members.join(own_shuffle(labels, "id"), "id", "left").select("key", "band", "id", component), "tagged")
    drawn = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("draw"), "id"))["id"]
    parts = tagged.groupBy("key", "component").agg(F.count("*").alias("n"), drawn.alias("pivot"))
    largest = F.max(F.struct("n", "component", "pivot")).alias("largest")
    buckets = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), largest).filter("parts > 1")
    return tagged, written(
        buckets.select("key", "n", (F.col("n") - F.col("largest.n")).alias("outsiders"), "largest.component", "largest.pivot")
        .withColumnRenamed("component", "main"),
        "open",
    )


def _left_over(tagged: DataFrame, buckets: DataFrame, faces: DataFrame, size: int, percent: int, miss: float) -> DataFrame:
    """Links of every outsider of an open bucket with the members of other components."""
    blocks = buckets.select(
        "key", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("all"), F.ceil(F.col("outsiders") / BLOCK).cast("int").alias("few")
    )
    rows = tagged.join(own_shuffle(blocks, "key"), "key").withColumn("outside", F.col("component") != F.col("main"))

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        own, across = ("few", "all") if asks else ("all", "few")
        unit = [F.col("across"), F.pmod(F.hash("id"), own).alias("own")]
        spread = rows.withColumn("across", F.explode(F.sequence(F.lit(0), F.col(across) - 1)))
        return spread.select(
            "key", "band", "id", "component", "outside", F.lit(asks).alias("asks"), F.array(*(unit if asks else unit[::-1])).alias("unit")
        )

    return written(
        dealt(rows.filter("outside"), True).union(dealt(rows, False)).join(faces, "id")
        .groupBy("key", "unit")
        .applyInArrow(_block_comparer(size, percent, miss), "a long, b long"),
        "others",
    )


def linked(members: DataFrame, faces: DataFrame, size: int, percent: int, miss: float) -> DataFrame:
    """(id, component) over all similar pairs that share a bucket; members: (key, band, id, pivot, n)."""

    def compared(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b"))
        return verified(ends.distinct(), faces, size, percent, miss)

    labels = written(components(compared(members.filter("id != pivot"))), "labels")
    members = members.filter("n > 2").drop("pivot", "n")
    turn, before = 0, None
    while True:
        tagged, buckets = _open_buckets(members, labels, turn)
        outsiders = buckets.agg(F.sum("outsiders")).first()[0] or 0
        known = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
        if not outsiders:
            return labels
        if before is not None and 2 * outsiders > before:
            return components(known.union(_left_over(tagged, buckets, faces, size, percent, miss)))
        pairs = tagged.join(own_shuffle(buckets.select("key", "main", "pivot"), "key"), "key").filter("component != main")
        labels = written(components(known.union(compared(pairs))), "labels")
        turn, before = turn + 1, outsiders


def _shared_ids(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): classes that hold rows of one id, each with the least of them."""
    mark = F.xxhash64("print")
    several = usable.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).filter("low <> high")
    held = usable.join(own_shuffle(several, "doc_id"), "doc_id").select("doc_id", "print").distinct()
    held = held.join(classes.select("print", "id"), "print")
    least = held.groupBy("doc_id").agg(F.min("id").alias("a"))
    return held.join(own_shuffle(least, "doc_id"), "doc_id").select("a", F.col("id").alias("b")).filter("a <> b")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of `docs`.

    Documents are linked if 100 * intersection >= percent * union of their sets of
    distinct `size`-word shingles (A-Z lower-cased).
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"), "text")
    signed = written(docs.mapInArrow(_signer(size), SIGNED), "signed")
    usable = signed.filter("print is not null and doc_id is not null")
    classes = usable.groupBy("print").agg(F.min("doc_id").alias("rep"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # numbers that last
    firsts = signed.join(classes.withColumnRenamed("rep", "doc_id"), ["print", "doc_id"])
    firsts = firsts.select("id", "doc_id", "tag", "sig", "bands").dropDuplicates(["id"])
    firsts = written(firsts, "firsts")
    entries = firsts.select("id", F.posexplode("bands").alias("band", "key"))
    full = entries.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    members = written(entries.join(own_shuffle(full, "key"), "key").select("key", "band", "id", "pivot", "n"), "members")
    faces = (
        members.select("id").distinct()
        .join(firsts.select("id", "doc_id", "tag", "sig"), "id")
        .join(docs.filter("doc_id is not null"), ["doc_id", "tag"])
        .dropDuplicates(["id"])  # rows may repeat
    )
    faces = written(faces.select("id", "sig", "text"), "faces")

    labels = linked(members, faces, size, percent, miss)
    shared = written(_shared_ids(usable, classes), "shared")
    if not shared.isEmpty():
        labels = components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).union(shared))
    rooted = classes.join(labels, "id", "left").select("print", "rep", F.coalesce("component", "id").alias("root"))
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_class = rooted.join(own_shuffle(least, "root"), "root").select("print", "component_id")
    rows = signed.select("doc_id", "n_shingles", "print").join(own_shuffle(by_class, "print"), "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )
