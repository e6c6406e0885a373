"""Shared lines, phrases and ranked search against brute force, with odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import phrase_mining
from siltstone.llm.ball_tree_search import BallTree, Items, Vectors, ranked, search
from siltstone.llm.line_runs import LineRuns, line_hashes, without_repeated_lines
from siltstone.llm.phrase_mining import collocations

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = " \t\n\x0b\x0c\r"


def rows(spark, given, kinds="doc_id long, text string"):
    return spark.createDataFrame(given, kinds)


# --- lines ---------------------------------------------------------------------------------------


def lines_by_hand(given, least_chars=20, least_docs=3):
    holders = defaultdict(set)
    for doc, text in given:
        if doc is not None and text is not None:
            for line in text.split("\n"):
                holders[line.strip(WHITE).translate(UPPER)].add(doc)
    out = []
    for doc, text in given:
        parts = (text or "").split("\n")
        kept = []
        for line in parts:
            key = line.strip(WHITE).translate(UPPER)
            gone = len(key) >= least_chars and len(holders[key]) >= least_docs and doc is not None and doc != max(holders[key])
            if not gone:
                kept.append(line)
        out.append((doc, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


SHARED = "a line that many pages share"
ODD_LINES = [
    (1, f"{SHARED}\nown line of the first page\n\n{SHARED.upper()} \t"),
    (2, f"  {SHARED}\r\n"),
    (3, SHARED),
    (7, f"x\n\x0b{SHARED}\x0c\nx"),
    (7, f"{SHARED}\n{SHARED}\nanother text of the same id"),
    (7, f"{SHARED}\n{SHARED}\nanother text of the same id"),
    (None, f"{SHARED}\nrow without an id"),
    (None, None),
    (8, None),
    (9, ""),
    (10, "\n\n"),
    (11, "ÉÈ zwanzig zeichen und mehr É"),
    (12, "éè zwanzig zeichen und mehr é"),
    (13, "ÉÈ ZWANZIG zeichen und mehr É"),
    (14, "ÉÈ zwanzig zeichen und mehr É"),
    (15, "kKİΣ more than twenty points"),
    (16, "kKİΣ more than twenty points"),
    (17, "KKİΣ More than twenty points"),
    (18, "kkiσ more than twenty points"),
    (19, "nineteen characters"),
    (20, "nineteen characters"),
    (21, "nineteen characters"),
    (22, " " * 50_000 + "\n" + "\n".join(f"{SHARED} {i % 700}" for i in range(5_000)) + " " * 50_000),
    (23, "\n".join(f"{SHARED} {i % 700}" for i in range(5_000))),
    (24, "\n".join(f"{SHARED} {i}" for i in range(700))),
]


def test_lines_odd_rows(spark):
    found = without_repeated_lines(rows(spark, ODD_LINES)).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert Counter(map(tuple, found)) == Counter(lines_by_hand(ODD_LINES))


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (7, 3)])
def test_lines_at_random(spark, batches, fanout):
    random.seed(batches)
    pool = [f"line number {i} of the shared pool" for i in range(12)] + ["short", "", "  "]
    given = [(random.randrange(60), "\n".join(random.choices(pool, k=random.randrange(6)))) for _ in range(150)]
    left = without_repeated_lines(rows(spark, given), batches=batches, fanout=fanout)
    assert Counter(map(tuple, left.select("doc_id", "n_lines", "n_dropped", "kept_text").collect())) == Counter(lines_by_hand(given))


def test_lines_further_columns(spark):
    df = rows(spark, [(i, SHARED, "x", i, 5) for i in range(4)], "doc_id int, text string, `a.b` string, h1 int, n_lines int")
    left = without_repeated_lines(df)
    assert left.columns == ["doc_id", "text", "a.b", "h1", "n_lines", "n_dropped", "kept_text"]
    assert sorted(r["n_dropped"] for r in left.collect()) == [0, 1, 1, 1]


def test_lines_empty(spark):
    assert without_repeated_lines(rows(spark, [])).collect() == []
    assert without_repeated_lines(rows(spark, [(None, None)])).count() == 1


def test_runs_settle_and_compact(spark):
    """A settled key is not written again, and runs are compacted by level."""
    runs = LineRuns(spark, least_docs=3, fanout=3)
    for batch in range(3, -1, -1):
        given = [(10 * batch + i, key) for i in range(4) for key in ("all", f"batch {batch}", f"doc {batch} {i}")]
        lines = rows(spark, given, "doc_id long, key string")
        runs.add(lines.select("doc_id", *line_hashes(F.col("key"))))
    assert [len(level) for level in runs.levels] == [1, 1]
    newest = spark.table(runs.levels[0][0])
    known = rows(spark, [(1, "all")], "i int, key string").select(*line_hashes(F.col("key")))
    assert newest.join(known, ["h1", "h2"]).count() == 0
    assert newest.count() == 5
    found = {r["last"] for r in runs.repeated().collect()}
    assert found == {33, 3, 13, 23}
    runs.close()


# --- phrases -------------------------------------------------------------------------------------


def phrases_by_hand(given, longest=3, least=10, cover=50, first=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in given:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_of = []
        for p, a in held.items():
            longer = [
                q for q, b in held.items()
                if len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not longer:
                s, _, left, right = min(
                    (10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
                )
                rows_of.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_of)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found_phrases(df, **kw):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in collocations(df, **kw).select(columns).collect())


@pytest.mark.parametrize(("longest", "first"), [(3, 2000), (3, 7), (2, 2000), (4, 2000)])
def test_phrases_at_random(spark, longest, first):
    random.seed(longest * first)
    words = ["The", "of", "new", "york", "É", "b-1", "city", "a"] + [f"w{i}" for i in range(30)]
    seps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " !", "\r\n"]
    given = []
    for _ in range(300):
        text = "".join(random.choice(words) + random.choice(seps) for _ in range(random.randrange(60)))
        given.append((random.choice(["en", "en", "en", "de", None]), text.replace("new ", "new york ")))
    given += given[:40]  # copies
    df = rows(spark, given, "lang string, text string")
    assert found_phrases(df, longest=longest, first=first) == phrases_by_hand(given, longest, first=first)


def test_phrases_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "LONGEST_CHUNK", 16)
    long_run = "same " * 3_000  # no trigger but the forced cuts
    given = [
        (None, None, "x", 1), ("en", "", "x", 1), ("en", " .,;:!?\n\t", None, 1), ("en", long_run, "x", None),
        ("en", "one two " * 20 + "x" * 100_000, "x", 1), ("de", "one two " * 20, "x", 1), (None, "One TWO. " * 15, "x", 1),
        ("", "one two " * 11, "x", 1),
    ]
    df = rows(spark, given, "lang string, text string, `a-b` string, n int")
    plain = [(g[0], g[1]) for g in given]
    assert found_phrases(df) == phrases_by_hand(plain)
    assert found_phrases(df.filter("false")) == []


def test_phrases_big_products(spark):
    """Scores whose products pass 64 bits."""
    counts = [
        rows(spark, [("en", "a", 4_000_000_000_000), ("en", "b", 3_000_000_000_001)], "lang string, phrase string, f long"),
        rows(spark, [("en", "a b", 2_999_999_999_999)], "lang string, phrase string, f long"),
    ]
    a, left, right = 2_999_999_999_999, 4_000_000_000_000, 3_000_000_000_001
    row = phrase_mining._scored(2, counts).first()
    assert (row["score"], row["l"], row["r"]) == (10**6 * a * a // (left * right), left, right)


def test_copies_are_one_chunk(spark):
    """Copied passages are cut alike, so they share entries of the dictionary."""
    passage = " ".join(f"word{i}" for i in range(400))
    df = rows(spark, [("en", f"start{i} of {i} " + passage) for i in range(20)], "lang string, text string")
    chunks = phrase_mining.dictionary(df).collect()
    assert sum(c["n"] * c["words"] for c in chunks) == 20 * 403
    shared = sum(c["words"] for c in chunks if c["n"] == 20)
    assert shared > 250
    assert len(chunks) < 20 * 2 + 60


# --- search --------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked_by_hand(docs, items, count=10):
    texts = [(doc, Counter(TERM.findall((text or "").translate(UPPER)))) for doc, text in docs]
    number = sum(1 for _, t in texts if t)
    total = sum(sum(t.values()) for _, t in texts)
    df = Counter(term for _, t in texts for term in t)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(UPPER)))
        found = []
        for doc, t in texts:
            score = 0
            n = sum(t.values())
            for term, times in asked.items():
                if term in t:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + 75 * n * number // total
                    score += times * w * (10**9 * t[term] // (1000 * t[term] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(found)[:count], 1):
            out.append((item, rank, None if none else doc, -score))
    return Counter(out)


def found_ranks(docs, items, **kw):
    return Counter(tuple(r) for r in ranked(docs, items, **kw).select("item_id", "rank", "doc_id", "score").collect())


def test_search_at_random(spark):
    random.seed(5)
    words = [f"t{i}" for i in range(200)] + ["É", "naïve", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(random.choices(words, weights, k=random.randrange(40)))) for i in range(600)]
    docs += [(700 + i, docs[i][1].upper()) for i in range(30)]  # ties
    items = [(i, ", ".join(random.choices(words, k=random.randrange(12)))) for i in range(40)]
    given = rows(spark, docs), rows(spark, items, "item_id long, text string")
    assert found_ranks(*given) == ranked_by_hand(docs, items)
    assert found_ranks(*given, count=3) == ranked_by_hand(docs, items, 3)


def test_search_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (None, "alpha beta"), (None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"),
        (4, "Alpha-beta_gamma"), (5, "delta " * 30_000), (6, "x" * 200_000 + " delta"), (7, "... !"),
    ]
    items = [(1, "alpha alpha beta"), (1, "delta"), (None, "gamma"), (2, None), (3, ""), (4, "missing"), (5, "beta " * 5_000)]
    kinds = "item_id long, text string, rank int, `a.b` string"
    asked = rows(spark, [(*i, 1, "x") for i in items], kinds)
    given = rows(spark, [(*d, 9, "x") for d in docs], "doc_id long, text string, score int, `a-b` string")
    assert found_ranks(given, asked) == ranked_by_hand(docs, items)
    assert found_ranks(given.filter("false"), asked) == Counter()
    assert found_ranks(given, asked.filter("false")) == Counter()


def test_tree_prunes_and_bounds(spark):
    """No member beats its node's bound, and an item with like documents looks into few leaves."""
    random_ = np.random.default_rng(3)
    size, topics = 2_000, 40
    terms = [np.unique(random_.integers(0, 10, 8) + 10 * (i % topics)) for i in range(size)]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
    values = random_.integers(10**6, 10**9, bounds[-1])
    flat = np.concatenate(terms)
    items = Items([0], np.arange(10 * topics, dtype=np.uint64), np.arange(10), np.zeros(10, dtype=np.int64), np.full(10, 2))
    tree = BallTree(Vectors(bounds.copy(), flat.copy(), values.copy()), items, leaf=16)
    asked = np.zeros(10 * topics, dtype=np.int64)
    asked[:10] = 2
    scores = tree.vectors.dot(asked)
    for (first, stop, _), bound in zip(tree.nodes, tree.bounds[:, 0], strict=True):
        assert scores[first:stop].max() <= bound
    true = Vectors(bounds, flat, values).dot(asked)
    assert (true[tree.order] == scores).all()
    best = []
    looked = search(tree, np.arange(size), 0, asked, best, 10)
    assert looked < 0.3 * sum(1 for node in tree.nodes if node[2] is None)
    assert sorted((-s, -i) for s, i in best) == sorted((-int(s), i) for i, s in enumerate(true))[:10]
