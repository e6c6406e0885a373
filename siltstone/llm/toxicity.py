"""Toxicity scores by a counterfactually regularised classifier.

Features of a text are its distinct words (letters, digits and underscores,
lower-cased) and their beginnings of 3 to 6 letters, present or not. The most
telling ones are picked by the log odds of the labelled texts that hold them, and a
logistic regression is fitted to them. Where a labelled text names a group of people,
a copy for every other term of the same kind (`groups`) is made; the squared difference
between the scores (before the logistic function) of text and copy is added to the
loss, so that naming a group does not move the score by itself.

Learning takes at most `sample` labelled texts (those with the least hash of their
id), at most `features` weights; both are sent around whole. Everything is scored.

A null or empty text has no features and gets the score of the intercept. A label
that is null or not 0 or 1 is left out; of several labels of an id one is taken. Rows
with null ids or texts, and repeated ones, are scored each. Columns of `docs` are
carried along unless named like one of the new columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import quoted, written

SAMPLE = 20_000
FEATURES = 8_192
LEAST_TEXTS = 3
PREFIXES = (3, 4, 5, 6)
HELD_WORDS = 200_000
SWAP_WEIGHT = 4.0
RIDGE = 1e-4
STEPS = 300

Groups = Sequence[Sequence[str]]

# Terms that may be swapped for each other.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("mujeres", "hombres"), ("femmes", "hommes"), ("frauen", "männer"),
    ("muslims", "christians", "jews", "hindus", "atheists"), ("muslim", "christian", "jewish", "hindu", "atheist"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"), ("immigrants", "citizens"),
    ("africans", "europeans", "americans", "mexicans", "chinese"), ("deaf", "blind", "disabled"),
)

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a hyphen."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]


def text_features(words: set[str]) -> set[str]:
    return {f for w in words for f in features_of(w)}


def swapped(words: set[str], groups: Groups = IDENTITY_TERMS) -> list[set[str]]:
    """The words with the terms of a group moved on by one place, by two and so on, for each group they name."""
    found = []
    for group in groups:
        if words.isdisjoint(group):
            continue
        for by in range(1, len(group)):
            other = {t: group[(i + by) % len(group)] for i, t in enumerate(group)}
            found.append({other.get(w, w) for w in words})
    return found


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean): texts of a task that hold each feature."""
    counts = (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update(text_features(words_of(text)))
    found = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(found), 50_000):
        some = found[at : at + 50_000]
        columns = [pa.array(some, pa.string()), *(pa.array([c[f] for f in some], pa.int64()) for c in (counts[1], counts[0]))]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "clean"])


def _encoder(index: dict[str, int], groups: Groups):
    def known(words: set[str]) -> list[int]:
        return sorted(index[f] for f in text_features(words) if f in index)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            words = [words_of(text) for text in batch.column(1).to_pylist()]
            own = [known(w) for w in words]
            others = [[known(turned) for turned in swapped(w, groups)] for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, kind), pa.array(others, pa.list_(kind))], names=["label", "own", "others"]
            )

    return encode


def fitted(
    labels: np.ndarray, own: list[list[int]], pairs: list[tuple[list[int], list[int]]], size: int, swap_weight: float = SWAP_WEIGHT
) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient steps with momentum and scaling.

    `pairs` are the features of texts and of their swapped copies.
    """
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    col = np.array([i for x in own for i in x], dtype=np.int64)
    pair_row = np.array([k for k, (a, b) in enumerate(pairs) for _ in (*a, *b)], dtype=np.int64)
    pair_col = np.array([i for a, b in pairs for i in (*a, *b)], dtype=np.int64)
    sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    if not len(labels):
        return np.zeros(size), float(np.log(0.5))
    n = len(labels)
    weights = np.zeros(size + 1)
    weights[size] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        margin = np.bincount(row, weights[col], len(own)) + weights[size]
        error = 1 / (1 + np.exp(-margin)) - labels
        slope = np.empty_like(weights)
        slope[:size] = np.bincount(col, error[row], size) / n + RIDGE * weights[:size]
        slope[size] = error.sum() / n
        if pairs:
            gap = np.bincount(pair_row, sign * weights[pair_col], len(pairs))
            slope[:size] += 2 * swap_weight / len(pairs) * np.bincount(pair_col, sign * gap[pair_row], size)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights[:size], float(weights[size])


def learned(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    features: int = FEATURES,
    groups: Groups = IDENTITY_TERMS,
    swap_weight: float = SWAP_WEIGHT,
) -> tuple[dict[str, float], float]:
    """Weight of each feature, and the intercept, from `labels` (doc_id, label)."""
    known = labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    taken = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded by `sample`, so it can be sent to all
    texts = docs.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts = written(texts.select("label", "text"), "labelled")
    total = texts.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    counts = texts.mapInArrow(_tally, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    odds = F.log((F.col("toxic") + 0.5) / (total[0] - F.col("toxic") + 0.5)) - F.log(
        (F.col("clean") + 0.5) / (total[1] - F.col("clean") + 0.5)
    )
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    picked = counts.filter(F.col("toxic") + F.col("clean") >= LEAST_TEXTS).orderBy(F.abs(odds / spread).desc(), "feature").limit(features)
    names = [r[0] for r in picked.select("feature").collect()]
    encode = _encoder({f: i for i, f in enumerate(names)}, groups)
    coded = texts.mapInArrow(encode, "label int, own array<int>, others array<array<int>>").collect()  # bounded by `sample`
    pairs = [(r["own"], other) for r in coded for other in r["others"] if r["own"] != other]
    own = [r["own"] for r in coded]
    weights, intercept = fitted(np.array([r["label"] for r in coded], dtype=float), own, pairs, len(names), swap_weight)
    return dict(zip(names, weights.tolist(), strict=True)), intercept


class _Parts(dict):
    """Features of a word that have a weight; held for HELD_WORDS words at most."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= HELD_WORDS:
            self.clear()
        found = self[word] = tuple(f for f in features_of(word) if f in self.weights)
        return found


def _scorer(model):
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, intercept = model.value
        parts = _Parts(weights)
        for batch in batches:
            found = []
            for text in batch.to_pylist():
                held = {f for p in map(parts.__getitem__, words_of(text)) if p for f in p}
                found.append(intercept + sum(weights[f] for f in sorted(held)))
            scores = 1 / (1 + np.exp(-np.clip(np.array(found), -500, 500)))
            yield pa.array(scores, pa.float64())

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    features: int = FEATURES,
    groups: Groups = IDENTITY_TERMS,
    swap_weight: float = SWAP_WEIGHT,
) -> DataFrame:
    """The columns of `docs` with score (0 to 1) and predicted (1 from 0.5 on).

    `groups` lists identity terms (lower case) that may stand for each other.
    """
    found = learned(docs.select("doc_id", "text"), labels, sample, features, groups, swap_weight)
    model = docs.sparkSession.sparkContext.broadcast(found)
    carried = [c for c in docs.columns if c not in ("score", "predicted")]
    score = F.arrow_udf(_scorer(model), "double")  # the texts alone go to Python, and none comes back
    scored = docs.select(*map(quoted, carried), score("text").alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
