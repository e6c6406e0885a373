"""The five stages on planted documents: each decision against what was planted."""

import random
import struct

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm.queries_text import WORD_BPE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `crawl-date` string"
draw = random.Random(9)
WORDS = [f"{a}{b}{c}" for a in ("mo", "ta", "ri", "lu", "se", "no") for b in ("ka", "li", "ve", "do") for c in ("n", "r", "s", "l", "m")]


def sentence(n: int) -> str:
    return " ".join(draw.choice(WORDS) for _ in range(n))


PASSAGE, ITEM = sentence(50), sentence(40)
PLAIN = {i: sentence(60) for i in range(1, 61)}
TEXTS = PLAIN | {
    101: PLAIN[1],  # a copy
    102: PLAIN[2] + " tail",  # a near copy
    103: f"{sentence(30)} {PASSAGE} {sentence(30)}",
    104: f"{sentence(30)} {PASSAGE} {sentence(30)}",
    105: f"{sentence(20)} {ITEM} {sentence(20)}",
    106: "\u2603\u2604\u2605 \u0416\u0416\u0416 " * 40,  # unlike anything trusted
    107: "",
}
ROWS = [(i, t, "en", "s", len(t), "d") for i, t in TEXTS.items()]
ROWS += [(108, None, None, None, None, None), (None, sentence(60), "en", "s", 1, "d"), (3, PLAIN[3], "en", "s", len(PLAIN[3]), "d")]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in PLAIN] + [(None, 1, 0), (106, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_decide_as_planted(spark, sf_dir):
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    found = corpus_pipeline.run(spark, sf_dir).collect()
    held = {}
    for r in found:
        held.setdefault(r.doc_id, []).append(r)
    gone = set(TEXTS) - set(held)
    assert {101, 102, 105, 106} <= gone
    assert len(gone) <= 4 + 3  # the threshold is a quantile of trusted texts
    assert 107 in held and 108 in held and len(held[None]) == 1
    assert all(len(rows) == 1 for rows in held.values())  # of repeated rows one is kept
    for key, rows in held.items():
        text = {103: None, 104: None}.get(key, TEXTS.get(key) or "")
        if text is None or key is None:
            continue
        ids = library.encode(text, add_special_tokens=False).ids
        assert all(bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids) for r in rows), key
    for key in {103, 104} & set(held):
        ids = library.encode(TEXTS[key].replace(f" {PASSAGE}", ""), add_special_tokens=False).ids
        assert bytes(held[key][0].ids) == struct.pack(f"<{len(ids)}I", *ids)


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, sf_dir)
        assert docs_after.columns == docs.columns
        assert stage(spark, docs.filter("false"), sf_dir).count() == 0
