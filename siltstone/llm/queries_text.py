"""Queries of the operators on documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bpe_codec import encoded
from siltstone.llm.common import query, table
from siltstone.llm.hash_shards import sharded
from siltstone.llm.kneser_ney import quality
from siltstone.llm.minhash_dedup import near_duplicates
from siltstone.llm.seeded_decontam import contaminated
from siltstone.llm.substring_dedup import without_repeats
from siltstone.llm.token_counts import token_counts
from siltstone.llm.toxicity import toxicity

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    coded = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the ids."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document, as digests."""
    left = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=35)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity of 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query()
def op5_benchmark_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
    with keyed as (
        select doc_id, cast(octet_length(encode(coalesce(text, ''))) as bigint) as n_bytes,
            cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 15) as bigint) as key
        from documents
    ), paths as (
        select key, n_bytes, cast(d.depth as integer) as depth, key >> (60 - d.depth) as prefix
        from keyed, (select unnest(range(0, 61)) as depth) d
    ), nodes as (
        select depth, prefix, cast(sum(n_bytes) as bigint) as shard_bytes from paths group by all
    ), leaves as (
        select p.key, min(n.depth) as depth
        from (select distinct key, depth, prefix from paths) p join nodes n on n.depth = p.depth and n.prefix = p.prefix
        where n.shard_bytes <= 8388608 group by p.key
    )
    select k.doc_id, k.n_bytes, l.depth, k.key >> (60 - l.depth) as prefix, n.shard_bytes, true as fits
    from keyed k join leaves l on l.key = k.key
        join nodes n on n.depth = l.depth and n.prefix = k.key >> (60 - l.depth)
    """
)
def op9_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, of 8 MiB of text at most."""
    return sharded(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query()
def op10_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document against its language's threshold; trusted are those labelled good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality(docs, trusted).select("doc_id", "lang", "perplexity", "threshold", "kept")
