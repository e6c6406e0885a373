"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return (
        both.filter("v > u")
        .join(own_shuffle(least, "u"), "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(own_shuffle(least, "u"), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every linked node: the smallest node it reaches.

    Links between a node and itself, null ends and repeats are left out. Every
    round is a few shuffles of at most as many rows as there are links, written to
    the shared folder; the number of rounds grows with the logarithm of the nodes.
    A node linked to a third of all others is one row per task after the partial
    minimum, and its join partition is one that AQE can split.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = written(edges, "links")
    mark = _fingerprint(edges)
    while mark[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        before, mark = mark, _fingerprint(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )
