"""Odd columns, repeated and null rows, and cases that once lost results."""

import random

import numpy as np
import pytest

from siltstone.llm import vector_dedup
from siltstone.llm.bpe_codec import encoded
from siltstone.llm.hash_shards import sharded
from siltstone.llm.kneser_ney import quality
from siltstone.llm.minhash_dedup import near_duplicates
from siltstone.llm.queries_text import WORD_BPE
from siltstone.llm.seeded_decontam import contaminated
from siltstone.llm.substring_dedup import without_repeats
from siltstone.llm.toxicity import toxicity
from siltstone.llm.vector_dedup import near_vectors

ODD = "doc_id long, lang string, text string, `crawl-date` string, `a.b` int, n_tokens int, score int, kept string, rest string"


def odd_docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "k", "r") for r in rows], ODD)


ROWS = [(1, "en", "one two three"), (1, "en", "one two three"), (None, None, "four"), (2, None, None), (3, "", "")]


def operators(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    return {
        "bpe": lambda d: encoded(d, WORD_BPE),
        "shards": lambda d: sharded(d),
        "repeats": lambda d: without_repeats(d, 2),
        "toxicity": lambda d: toxicity(d, labels),
        "quality": lambda d: quality(d, labels.select("doc_id")),
        "quality by chunk": lambda d: quality(d, labels.select("doc_id"), broadcast_rows=0),
        "near": lambda d: near_duplicates(d),
    }


@pytest.mark.parametrize("name", ["bpe", "shards", "repeats", "toxicity", "quality", "quality by chunk", "near"])
def test_odd_columns_and_rows(spark, name):
    run = operators(spark)[name]
    docs = odd_docs(spark, ROWS)
    found = run(docs)
    assert found.count() == len(ROWS)
    if name != "near":
        assert {"crawl-date", "a.b", "rest"} <= set(found.columns)
        assert len(set(found.columns)) == len(found.columns)
    assert run(docs.filter("false")).count() == 0


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.predicted for r in toxicity(odd_docs(spark, ROWS), none).collect()} == {0}


def test_near_rows_that_repeat_an_id(spark):
    """Ids over two texts keep the links of both."""
    random.seed(1)
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    given = [(1, a), (1, b), (2, a + " q"), (3, b + " q"), (4, a + " q"), (4, a + " q"), (5, "alone here with these words")]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, size=3, percent=85).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_short_items_are_found_word_for_word(spark):
    docs = spark.createDataFrame(
        [(1, "They asked: What is the capital of France? Then left."), (2, "what is the capital of spain"), (3, "yes"), (4, None)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "what is the capital of france"), (2, "Yes."), (3, ""), (4, None)], "item_id long, text string")
    assert {tuple(r) for r in contaminated(docs, items).collect()} == {(1, 1), (3, 2)}
    assert {tuple(r) for r in contaminated(docs, items, least_tokens=3).collect()} == {(1, 1)}


def test_vectors_in_doubles(spark):
    given = [(1, [1e300, 0.0]), (2, [1e-300, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 1e-9]), (5, [0.0, 1.0]), (6, [float("nan"), 1.0]), (7, None)]
    given += [(8, [0.0, 0.0]), (9, [None, 1.0]), (10, [float("inf"), 1.0])]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), **{i: (0, i) for i in range(5, 11)}}


def test_vectors_over_several_shards(spark, monkeypatch):
    """Against brute force, with shards of many blocks and groups of near copies."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    random_ = np.random.default_rng(8)
    base = random_.normal(size=(250, 16))
    noise = random_.normal(size=(500, 16)) * 0.08
    vectors = np.concatenate((base, base[random_.integers(0, 250, 500)] + noise)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in near_vectors(df).collect()}
    units = vectors.astype(np.float64) / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    links = (units @ units.T >= 0.95) & ~np.eye(len(units), dtype=bool)
    true = links.sum(axis=1)
    assert true.sum() > 500
    assert all(found[i].n_links <= true[i] for i in found)
    assert sum(found[i].n_links for i in found) >= 0.95 * true.sum()
