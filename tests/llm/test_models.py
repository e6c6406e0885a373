"""Learned operators on the given tables: held-out accuracy, and defined results for odd rows."""

import pytest
from pyspark.sql import functions as F

from siltstone.llm.kneser_ney import quality
from siltstone.llm.queries_text import op6_toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_toxicity(spark, labels):
    scored = op6_toxicity(spark, SF).filter("held_out")
    right = scored.join(labels, "doc_id").select(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    usual = labels.select(F.greatest(F.avg("toxic"), 1 - F.avg("toxic"))).first()[0]
    assert right >= max(0.9, usual)


def test_quality_keeps_trusted_texts_and_defines_odd_rows(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    odd = spark.createDataFrame([(-1, None, "some text"), (-2, "en", None), (-3, "en", ""), (None, "en", "x")], docs.schema)
    found = quality(docs.union(odd), labels.filter("quality = 1")).select("doc_id", "kept").collect()
    assert len(found) == docs.count() + 4
    assert all(r.kept is not None for r in found)
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert sum(r.kept for r in found if r.doc_id in good) >= 0.9 * len(good)
