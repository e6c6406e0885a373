"""Token counts by heap-and-linked-list byte-pair merging.

The count of a word is its symbols (bytes) less the merges done; no identifiers are
made. Counts of words met before are held per worker, HELD_WORDS at most of up to
HELD_CHARS characters each. Special strings inside a text count one each, as the
library has it by default.

A null text counts as an empty one: 0 bytes, 0 tokens. Every row gives one row,
repeated ones too; further columns are ignored. A text of any length is one row's
work; a word of n bytes takes O(n log n) steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.bpe import BEYOND, BYTE_PATTERN, HELD_CHARS, HELD_WORDS, Vocabulary, file_content, merged, vocabulary
from siltstone.llm.common import per_process


class _Counts(dict):
    """Tokens of a word, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        symbols = self.vocabulary.symbols(word)
        count = len(symbols) - merged(symbols, self.vocabulary.ranks)[1]
        if len(word) <= HELD_CHARS:
            if len(self) >= HELD_WORDS:
                self.clear()
            self[word] = count
        return count


def _words(text: str, vocab: Vocabulary, pattern) -> list[str]:
    if BEYOND.search(text) is None:
        return pattern.findall(text)
    raw = vocab.tokenizer.pre_tokenizer.pre_tokenize_str(text)
    return [text[a:b] for _, (a, b) in raw]


def _counter(content):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content.value)
        counts = per_process(f"counts {hash(content.value)}", lambda: _Counts(vocab))
        pattern = regex.compile(BYTE_PATTERN)
        tokens_of = counts.__getitem__
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                total = 0
                at = 0
                for special in vocab.special.finditer(text):
                    total += 1 + sum(map(tokens_of, _words(text[at : special.start()], vocab, pattern)))
                    at = special.end()
                found.append(total + sum(map(tokens_of, _words(text[at:], vocab, pattern))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return count


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each text under a byte-level vocabulary."""
    content = docs.sparkSession.sparkContext.broadcast(file_content(path))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(_counter(content), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
