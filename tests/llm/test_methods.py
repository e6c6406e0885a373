"""The heart of each method at work: windows that grow, penalties that bite, hosts that are blocked."""

import random
import struct

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from siltstone.llm.bpe import file_content, vocabulary
from siltstone.llm.bpe_codec import PIECE, RUN, Encoder, encoded, pieces
from siltstone.llm.host_reputation import judged
from siltstone.llm.queries_text import WORD_BPE
from siltstone.llm.common import ORACLES
from siltstone.llm.queries_web import RULES, op3_host_reputation
from siltstone.llm.toxicity import swapped, toxicity

ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyzABC",
    "accents": "éèüñøßİſÅ",
    "combining": "e\u0301a\u0308o\u0323\u0302",
    "greek": "αβγδεΣσςάώ",
    "cyrillic": "абвгдежзийЙё",
    "thai": "กขคงจฉชซาะเแโไำิีึื่้๊",
    "devanagari": "कखगघङचछजझञ\u0958\u0959ािी",
    "arabic": "ابتثجحخدذرزس",
    "han": "的一是不了人我在有他",
    "kana": "あいうえおかきがぎアイウガ",
    "hangul": "가각간갇갈",
    "jamo": "\u1100\u1161\u11a8\u1102\u1162",
    "marks": "!?.,;:-_=+~",
    "digits": "0123456789",
    "mixed": "aбกé1!的\u0301",
}


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(WORD_BPE)
    found.no_truncation()
    found.no_padding()
    return found


def unbroken(alphabet: str, length: int, seed: int = 1) -> str:
    draw = random.Random(seed)
    return "".join(draw.choice(alphabet) for _ in range(length))


@pytest.mark.parametrize("name", ALPHABETS)
@pytest.mark.parametrize("size", [7, 40, 300])
def test_pieces_of_unbroken_runs_join_to_the_library_s_ids(library, name, size):
    vocab = vocabulary(file_content(WORD_BPE))
    encoder = Encoder(vocab)
    for text in (unbroken(ALPHABETS[name], 2500), unbroken(ALPHABETS[name][:2], 1500, 2)):
        cut = pieces(text, vocab.special, size)
        assert "".join(t for t, _ in cut) == text
        ids = encoder.tree(encoder.encode([t for t, _ in cut]), [k for _, k in cut])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    if name in ("latin", "greek", "cyrillic", "arabic", "han", "kana", "hangul", "marks"):
        assert sum(k == RUN for _, k in pieces(unbroken(ALPHABETS[name], 2500), vocab.special, size)) > 2


def test_long_unbroken_texts_are_cut_and_grown(spark, library):
    names = ["latin", "accents", "combining", "thai", "cyrillic", "han", "marks"]
    texts = {i: unbroken(ALPHABETS[n], 2 * PIECE + 5000) for i, n in enumerate(names)}
    special = vocabulary(file_content(WORD_BPE)).special
    for i, text in texts.items():
        assert max(len(t) for t, _ in pieces(text, special)) < PIECE + 1000, names[i]
    for r in encoded(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), WORD_BPE).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids), names[r.doc_id]
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_swaps_reach_every_term_of_a_group():
    groups = [("red", "green", "blue"), ("left", "right")]
    assert swapped({"a", "b"}, groups) == []
    assert swapped({"red", "x"}, groups) == [{"green", "x"}, {"blue", "x"}]
    assert swapped({"red", "blue", "left"}, groups) == [{"green", "red", "left"}, {"blue", "green", "left"}, {"red", "blue", "right"}]


def test_the_penalty_takes_the_score_off_group_names(spark):
    """Toxic examples name one group far more often; neutral mentions of it must not score higher."""
    draw = random.Random(4)
    neutral = [f"word{i}" for i in range(30)]
    rows = []
    for i in range(400):
        toxic = i % 2
        words = [draw.choice(neutral) for _ in range(6)]
        words.append("redfolk" if draw.random() < (0.9 if toxic else 0.1) else "greenfolk")
        if toxic:
            words.append(draw.choice(["awful", "vile", "nasty"]))
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    mentions = spark.createDataFrame([(1000, "word1 word2 redfolk"), (1001, "word1 word2 greenfolk"), (1002, "vile greenfolk")], "doc_id long, text string")
    asked = docs.select("doc_id", "text").union(mentions)

    def scores(weight):
        found = toxicity(asked, docs.select("doc_id", "label"), groups=[("redfolk", "greenfolk")], swap_weight=weight)
        return {r.doc_id: (r.score, r.predicted) for r in found.collect()}

    def margin(p):
        return np.log(p / (1 - p))

    plain, mended = scores(0.0), scores(4.0)
    gaps = [margin(s[1000][0]) - margin(s[1001][0]) for s in (plain, mended)]
    assert gaps[0] > 0.5 and abs(gaps[1]) < 0.1 * gaps[0]
    assert mended[1002][1] == 1 and mended[1000][1] == mended[1001][1] == 0
    assert np.mean([mended[i][1] == t for i, _, t in rows]) >= 0.95


def test_reputation_blocks_hosts_by_their_bound(spark):
    """A host with many bad pages is blocked, one with a single bad page is not, and kin lend weight."""
    sites = {"bad.net": (30, 25), "once.net": (1, 1), "good.net": (40, 1), "a.farm.biz": (40, 38), "b.farm.biz": (40, 39), "c.farm.biz:8080": (2, 2), "unseen.net": (0, 0), "x.co.uk": (30, 29), "y.co.uk": (3, 0)}
    pages, outcomes = [], []
    for host, (n, bad) in sites.items():
        for i in range(max(n, 1)):
            pages.append((len(pages), f"http://{host.upper()}/p{i}?q"))
            if i < n:
                outcomes.append((pages[-1][0], int(i < bad)))
    pages += [(None, "http://bad.net/x"), (0, "http://bad.net/p0")]
    found = judged(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), RULES).collect()
    assert len(found) == len(pages)
    verdicts = {h: {r.verdict for r in found if r.host == h} for h in sites}
    assert verdicts["bad.net"] == verdicts["a.farm.biz"] == verdicts["b.farm.biz"] == verdicts["c.farm.biz:8080"] == verdicts["x.co.uk"] == {"block"}
    assert verdicts["once.net"] == verdicts["good.net"] == verdicts["unseen.net"] == verdicts["y.co.uk"] == {"allow"}


def test_reputation_agrees_with_its_sql(spark, tmp_path):
    """On pages most of which no rule decides, many of them labelled."""
    draw = random.Random(3)
    hosts = [f"{a}{b}" for a in ("", "www.", "m.", "u@shop.") for b in ("one.net", "two.net:81", "x.co.uk", "y.co.uk", "z.info", "co.uk", "org", "127.0.0.1", "")]
    rates = {h: draw.choice([0.05, 0.5, 0.95]) for h in hosts}
    pages = [(i, f"https://{draw.choice(hosts)}/en/{i}") for i in range(4000)] + [(None, None), (7, "x")]
    labels = [(i, int(draw.random() > rates[u.split("/")[2]]), 0) for i, u in pages[:-2] if i % 2]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    connection = duckdb.connect()
    for name in ("pages", "labels"):
        connection.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    mine = [tuple(r) for r in op3_host_reputation(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    theirs = connection.execute(f"select page_id, host, path, rule, verdict from ({ORACLES['op3_host_reputation']})").fetchall()
    assert sorted(map(str, mine)) == sorted(map(str, theirs))
    assert {r[4] for r in mine if r[3] is None} == {"allow", "block"}
