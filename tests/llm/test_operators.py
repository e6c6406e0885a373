"""Operators against the libraries or brute force, with nulls, empty texts and repeated rows."""

import random
import re
import struct
from collections import Counter
from itertools import combinations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltstone.llm.bpe_codec import encoded
from siltstone.llm.hash_shards import sharded
from siltstone.llm.minhash_dedup import near_duplicates
from siltstone.llm.queries_web import RULES
from siltstone.llm.host_reputation import judged
from siltstone.llm.seeded_decontam import contaminated
from siltstone.llm.substring_dedup import without_repeats
from siltstone.llm.token_counts import token_counts
from siltstone.llm.vector_dedup import near_vectors

LONG = " ".join(f"word{i % 97} größer{i}" for i in range(6000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank TODAY"),
    (3, None),
    (4, ""),
    (5, "two words"),
    (6, "two words"),
    (7, f"start {PASSAGE} end"),
    (8, f"other {PASSAGE} tail 日本語\x00 x"),
    (9, LONG),
    (10, "a" * 5000),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(TEXTS, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_codec_matches_the_library(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    found = {r.doc_id: r for r in encoded(docs, path).collect()}
    for key, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert bytes(found[key].ids) == struct.pack(f"<{len(ids)}I", *ids), key
        assert found[key].decoded == library.decode(ids, skip_special_tokens=False), key
    assert encoded(empty, path).count() == 0


def test_token_counts_match_the_library(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    for r in token_counts(docs, path, limit=512).collect():
        text = dict(TEXTS)[r.doc_id] or ""
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids), r.doc_id
        assert (r.n_bytes, r.over_limit) == (len(text.encode()), r.n_tokens > 512)
    assert token_counts(empty, path, limit=512).count() == 0


def test_repeats_match_brute_force(docs, empty):
    starts = Counter(tuple(words(t)[i : i + 35]) for _, t in TEXTS for i in range(len(words(t)) - 34))
    for r in without_repeats(docs, length=35).collect():
        own = words(dict(TEXTS)[r.doc_id])
        gone = {j for i in range(len(own) - 34) if starts[tuple(own[i : i + 35])] > 1 for j in range(i, i + 35)}
        assert (r.n_words, r.n_removed) == (len(own), len(gone)), r.doc_id
        assert r.kept_text == " ".join(w for i, w in enumerate(own) if i not in gone)
    assert without_repeats(empty).count() == 0


def shingles(text, size=3):
    own = words((text or "").lower())
    return {tuple(own[i : i + size]) for i in range(max(len(own) - size + 1, min(len(own), 1)))}


def lowest_reachable(sets, percent=85):
    lowest = {k: k for k in sets}
    for a, b in combinations(sets, 2):
        if sets[a] and lowest[a] != lowest[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((lowest[a], lowest[b]))
            lowest = {k: low if v == high else v for k, v in lowest.items()}
    return lowest


def test_near_duplicates_match_brute_force(docs, empty):
    sets = {k: shingles(t) for k, t in TEXTS}
    lowest = lowest_reachable(sets)
    found = {r.doc_id: tuple(r)[1:] for r in near_duplicates(docs, size=3, percent=85).collect()}
    assert found == {k: (len(sets[k]), lowest[k], lowest[k] == k) for k in sets}
    assert near_duplicates(empty).count() == 0


def test_large_group_around_the_threshold(spark):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = {k: " ".join(f"x{k}" if draw.random() < 0.004 * (k % 12) else w for w in base) for k in range(1, 400)}
    sets = {k: shingles(t) for k, t in texts.items()}
    lowest = lowest_reachable(sets)
    assert 20 < len(set(lowest.values())) < 350
    found = near_duplicates(spark.createDataFrame(list(texts.items()), SCHEMA), size=3, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == lowest


def test_near_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {tuple(r)[:3] for r in near_vectors(vectors).collect()}
    assert found == {(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7)}


def test_passages_of_the_benchmark_are_found(spark, docs):
    items = spark.createDataFrame([(70, PASSAGE), (71, "nothing of the kind is said in any text here at all"), (72, None)], "item_id long, text string")
    assert {tuple(r) for r in contaminated(docs, items).collect()} == {(7, 70), (8, 70)}


def test_shards_hold_all_rows_within_the_limit(docs):
    found = sharded(docs, limit=60000).collect()
    assert sorted(r.doc_id for r in found) == [k for k, _ in TEXTS]
    for shard in {(r.depth, r.prefix) for r in found}:
        own = [r for r in found if (r.depth, r.prefix) == shard]
        assert sum(r.n_bytes for r in own) == own[0].shard_bytes
        assert not own[0].fits or own[0].shard_bytes <= 60000


def test_rules_decide_before_reputation(spark):
    urls = [(1, "https://A.Example.org/en/1x?q"), (2, "http://b.org/z"), (3, "http://x.com/de/1#f"), (4, None), (5, "no scheme")]
    outcomes = spark.createDataFrame([(2, 1)], "page_id long, bad int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark.createDataFrame(urls, "page_id long, url string"), outcomes, RULES).collect()}
    assert found[1] == ("a.example.org", "/en/1x", "example.org/en/1", "block")
    assert found[2] == ("b.org", "/z", "org/", "allow")
    assert found[3] == ("x.com", "/de/1", "com/de/", "block")
    assert found[4][:3] == found[5][:3] == ("", "", None)
