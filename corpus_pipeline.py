"""Training-corpus pipeline: quality, near-duplicates, repeats, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept;
all but the last return the columns of documents. Rows with a null id pass the
stages that decide by id; null texts pass all and end as no tokens. Of rows that repeat
an id and its text the near-duplicate stage keeps one; rows of one id with other texts
share what is decided by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bpe_codec import encoded
from siltstone.llm.common import own_shuffle, quoted, table, written
from siltstone.llm.kneser_ney import quality
from siltstone.llm.minhash_dedup import near_duplicates
from siltstone.llm.seeded_decontam import contaminated
from siltstone.llm.substring_dedup import without_repeats

#: No SQL: signatures, language model and tokenizer are beyond it.
ORACLE_SQL = None


def _own(docs: DataFrame) -> list[str]:
    return [quoted(c) for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's perplexity threshold; trusted are those labelled good."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality(docs, trusted).filter("kept").select(_own(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8 or more)."""
    found = written(near_duplicates(docs, size=5, percent=80).select("doc_id", "kept"), "found")
    gone = found.filter("not kept").select("doc_id").distinct()
    left = docs.join(own_shuffle(gone, "doc_id"), "doc_id", "left_anti").select(_own(docs))
    repeated = found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    again = own_shuffle(written(repeated, "repeated"), "doc_id")
    single = left.join(again, "doc_id", "left_anti").select(_own(docs))
    return single.union(left.join(again, "doc_id", "left_semi").select(_own(docs)).dropDuplicates(["doc_id", "text"]))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows of 35 words that occur more than once."""
    left = without_repeats(docs, length=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = left.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(_own(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(own_shuffle(found.select("doc_id").distinct(), "doc_id"), "doc_id", "left_anti").select(_own(docs))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian unsigned 32-bit), with a digest of what they decode to."""
    coded = encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("repeats", repeats_stage),
    ("decontamination", decontamination_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
