"""Near-duplicate vectors by robust-pruned flat graphs over overlapping shards.

Equal vectors are one class with the smallest id as its representative; only
representatives are indexed, all of them. Centroids are fitted on at most `SAMPLE`
of them, and each representative goes to the shards of its `overlap` nearest
centroids. Each shard builds a flat graph: candidates of a node are its nearest
members and a few at random, thinned by robust pruning (a candidate goes if a chosen
one is nearer to it, by ALPHA, than the node is). The lists of a node from all its
shards are united. Then every node is searched for from the shard's medoid by greedy
beam search, which goes on through every node in a slightly wider range than asked
until no new one turns up, so that large groups are found whole. Links found are
verified by their cosine in double precision; a pair met in several shards counts in
the first one that both are in.

Shards are cut into blocks of `BLOCK` members, and every pair of blocks is a task of
its own, so a shard of any size is searched in bounded memory and loses no pair.

Recall is audited against brute force for `AUDITED` representatives (bounded, sent to
all tasks); below `least_recall` the index is built again with one more shard for each
vector, up to all of them.

Vectors that are null, zero, or hold nulls, NaN or infinities link with nothing and
are components of their own; a null id has a null component and is kept. Vectors of
different lengths do not link. Repeated rows are vectors of their own. Further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, written
from siltstone.llm.graph import components

SAMPLE = 20_000
BLOCK = 1_024
OVERLAP = 3
NEAREST, RANDOM, DEGREE, ALPHA = 48, 8, 24, 1.2
BEAM, SLACK = 16, 0.05
AUDITED, LEAST_RECALL = 200, 0.9


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def fitted_centroids(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; rows without members keep their centroid."""
    random = np.random.default_rng(3)
    centroids = sample[random.choice(len(sample), count, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i : i + 2048] @ centroids.T).argmax(axis=1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def robust_pruned(units: np.ndarray, seed: int = 5) -> list[np.ndarray]:
    """Neighbour lists of a flat graph over all rows."""
    n = len(units)
    if n < 2:
        return [np.zeros(0, dtype=np.int64) for _ in range(n)]
    random = np.random.default_rng(seed)
    x = units.astype(np.float32)
    lists = []
    for at in range(0, n, 256):
        near = x[at : at + 256] @ x.T
        own = np.arange(len(near))
        near[own, at + own] = -2
        top = np.argpartition(-near, min(NEAREST, n - 1) - 1, axis=1)[:, : min(NEAREST, n - 1)]
        candidates = np.concatenate((top, random.integers(0, n, (len(near), RANDOM))), axis=1)
        distance = 1 - np.take_along_axis(near, candidates, axis=1)
        distance[candidates == (at + own)[:, None]] = np.inf
        order = np.argsort(distance, axis=1, kind="stable")
        candidates, distance = (np.take_along_axis(v, order, axis=1) for v in (candidates, distance))
        open_ = np.isfinite(distance)
        chosen = np.full((len(near), DEGREE), -1, dtype=np.int64)
        for slot in range(DEGREE):
            some = open_.any(axis=1)
            if not some.any():
                break
            first = open_.argmax(axis=1)
            picked = candidates[own, first]
            chosen[some, slot] = picked[some]
            between = 1 - np.einsum("qcd,qd->qc", x[candidates], x[picked])
            open_ &= ~((ALPHA * between <= distance) & some[:, None])
            open_[own, first] = False
        lists += [c[c >= 0] for c in chosen]
    return lists


def range_searched(units: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, least: float) -> list[np.ndarray]:
    """For each query row, the rows found with a cosine of at least `least` (itself too)."""
    n = len(units)
    x = units.astype(np.float32)
    degree = max(1, max(map(len, lists), default=1))
    table = np.full((n, degree), -1, dtype=np.int64)
    for i, near in enumerate(lists):
        table[i, : len(near)] = near
    medoid = int((x @ x.mean(axis=0)).argmax())
    out = []
    for at in range(0, len(queries), 128):
        asked = queries[at : at + 128]
        rows = np.arange(len(asked))
        score = np.full((len(asked), n), -2, dtype=np.float32)  # -2: not met yet
        expanded = np.zeros((len(asked), n), dtype=bool)
        score[:, medoid] = x[asked] @ x[medoid]
        while True:
            beam = min(BEAM, n)
            floor = np.partition(score, n - beam, axis=1)[:, n - beam]
            due = (score > -2) & ~expanded & ((score >= floor[:, None]) | (score >= least - SLACK))
            q, node = np.nonzero(due)
            if not len(q):
                break
            expanded[q, node] = True
            for part in range(0, len(q), 20_000):
                to = table[node[part : part + 20_000]]
                pair = np.unique((np.repeat(q[part : part + 20_000], degree) * n + to.ravel())[to.ravel() >= 0])
                new_q, new = pair // n, pair % n
                fresh = score[new_q, new] == -2
                new_q, new = new_q[fresh], new[fresh]
                score[new_q, new] = np.einsum("pd,pd->p", x[asked[new_q]], x[new])
        out += [np.flatnonzero(score[i] >= least - 1e-5) for i in rows]
    return out


def _router(sent, overlap: int):
    def route(batches):
        centroids = sent.value
        for batch in batches:
            units = unit_rows(batch.column(2))
            near = units @ centroids.T
            count = min(overlap, len(centroids))
            shards = np.sort(np.argpartition(-near, count - 1, axis=1)[:, :count], axis=1).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, shards.size + 1, count, dtype=np.int32)), pa.array(shards.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "copies", "v", "shards"])

    return route


def _builder(unit: pa.Table) -> pa.Table:
    ids = unit.column("id").to_numpy()
    lists = robust_pruned(unit_rows(unit.column("v")))
    return pa.table({"id": ids, "near": pa.array([ids[near] for near in lists], pa.list_(pa.int64()))})


def _searcher(threshold: float):
    def search(unit: pa.Table) -> pa.Table:
        ids, copies, block = (unit.column(c).to_numpy() for c in ("id", "copies", "block"))
        shard, one, two = (unit.column(c)[0].as_py() for c in ("shard", "one", "two"))
        shards = np.array(unit.column("shards").to_pylist())
        units = unit_rows(unit.column("v"))
        order = np.argsort(ids)
        lists = []
        for near in unit.column("near").to_pylist():
            near = np.array(near, dtype=np.int64)
            at = np.minimum(np.searchsorted(ids[order], near), len(ids) - 1)
            lists.append(order[at[ids[order[at]] == near]])
        queries = np.flatnonzero(block == one)
        found = range_searched(units, lists, queries, threshold)
        a = np.repeat(queries, [len(f) for f in found])
        b = np.concatenate(found) if found else a
        cross = one != two
        keep = (block[b] == two) & ((a != b) | cross)
        a, b = a[keep], b[keep]
        if not cross:  # found from either side
            a, b = (np.concatenate(p) for p in ((a, b), (b, a)))
            both = np.unique(a * len(ids) + b)
            a, b = both // len(ids), both % len(ids)
        if len(a):
            parts = range(0, len(a), 50_000)
            exact = np.concatenate([np.einsum("pd,pd->p", units[a[i : i + 50_000]], units[b[i : i + 50_000]]) for i in parts])
            first = np.concatenate([_first_common(shards[a[i : i + 50_000]], shards[b[i : i + 50_000]]) for i in parts])
            keep = (exact >= threshold) & (first == shard)
            a, b = a[keep], b[keep]
        if cross:
            a, b = np.concatenate((a, b)), np.concatenate((b, a))
        links = np.bincount(a, copies[b], len(ids)).astype(np.int64)
        by_id = np.argsort(ids)
        rank = np.argsort(by_id)
        while True:  # the least id reached, hop by hop
            least = rank.copy()
            np.minimum.at(least, a, rank[b])
            if (least == rank).all():
                break
            rank = least
        roots = ids[by_id[rank]]
        some = np.flatnonzero(links > 0)
        return pa.table({"id": ids[some], "links": links[some], "root": roots[some]})

    return search


def _first_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least shard that is in both rows."""
    both = (x[:, :, None] == y[:, None, :]).any(axis=2)
    return np.where(both, x, np.iinfo(np.int32).max).min(axis=1)


def _indexed(reps: DataFrame, count: int, overlap: int, threshold: float) -> DataFrame:
    """(id, links, root) of the representatives that link with others in a shard."""
    spark = reps.sparkSession
    kind = reps.schema["v"].dataType.simpleString()
    sample = unit_rows(
        reps.orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toArrow().column(0)  # bounded by SAMPLE
    )
    clusters = max(1, min(-(-count // BLOCK), len(sample) // 4))
    sent = spark.sparkContext.broadcast(fitted_centroids(sample, clusters))
    routed = reps.select("id", "copies", "v").mapInArrow(_router(sent, overlap), f"id long, copies long, v {kind}, shards array<int>")
    members = written(routed.withColumn("shard", F.explode("shards")), "members")
    blocks = members.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(own_shuffle(blocks, "shard"), "shard").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    )
    placed = placed.select("shard", "one", "two", "block", "id", "copies", "v", "shards")
    groups = ["shard", "one", "two"]
    graph = placed.select(*groups, "id", "v").groupBy(*groups).applyInArrow(_builder, "id long, near array<long>")
    lists = graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    with_lists = placed.join(written(lists, "lists"), "id")
    return written(with_lists.groupBy(*groups).applyInArrow(_searcher(threshold), "id long, links long, root long"), "links")


def recall(reps: DataFrame, found: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Share of the true links of some representatives that `found` (id, links) holds."""
    some = reps.orderBy(F.xxhash64("id", F.lit(1))).limit(audited).select("id", "v").toArrow()  # bounded by `audited`
    ids, units = some.column(0).to_numpy(), unit_rows(some.column(1))

    def count(batches):
        for batch in batches:
            near = unit_rows(batch.column(2)) @ units.T >= threshold
            near &= batch.column(0).to_numpy()[:, None] != ids
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(batch.column(1).to_numpy() @ near)], names=["id", "true"])

    true = reps.select("id", "copies", "v").mapInArrow(count, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    total = true.join(links, "id", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return total[1] / total[0] if total[0] else 1.0


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, overlap: int = OVERLAP, least_recall: float = LEAST_RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of `vectors`."""
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    reps = rows.filter(usable).groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    reps = written(reps.select("id", "copies", "v"), "reps")

    parts = []
    for size, count in sorted((r[0], r[1]) for r in reps.groupBy(F.size("v")).count().collect()):
        own = reps.filter(F.size("v") == size)
        shards = overlap
        while True:
            found = _indexed(own, count, shards, threshold)
            if recall(own, found, threshold) >= least_recall or shards * BLOCK >= count:
                break  # good enough, or every vector is in every shard
            shards += 1
        parts.append(found)
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_class = (
        reps.join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
        .join(labels, "id", "left")
        .select("v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component"))
    )
    component = F.when(F.col("vec_id").isNotNull(), F.when(usable, F.col("component")).otherwise(F.col("vec_id")))
    joined = rows.join(own_shuffle(by_class, "v"), "v", "left")
    return joined.select(
        "vec_id",
        F.when(usable, F.col("links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
