"""Byte-pair encoding and decoding of whole texts, long ones in parallel pieces.

A text over PIECE characters is cut into pieces. A cut is made before white space,
between two digits, or, in a stretch without either, inside a run of letters or of
punctuation marks, or between a mark and a letter (never inside a special string, a
contraction or a place where normalisation reaches across; a run of combining marks is
put in order as a whole, so it is not cut). Pieces are encoded on their own, spread over all
tasks, and joined two by two as a tree. A join inside a run re-encodes a window of
tokens around it, growing to both sides until its first and last token are those
that the two halves have there: then all neighbouring tokens fit each other, and
such a sequence is the encoding of the whole run.

A null text is encoded as an empty one. Every row gives one row, repeated ones too;
further columns are carried along unless named like one of the new columns.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.bpe import BEYOND, HELD_CHARS, HELD_WORDS, WORD_PATTERN, Vocabulary, file_content, merged, vocabulary
from siltstone.llm.common import per_process, whole_row, with_rest

PIECE = 32_768

FREE, RUN = 0, 1
# Letters of every script, but for the Hangul ones that normalisation joins to syllables.
_LETTER = r"[\p{L}--[\u1100-\u11FF\uA960-\uA97F\uD7B0-\uD7FF]]"
_RUNS = (_LETTER, r"[!-&*+,\-./:;=?@\[\\\]^_`{}~]")
_RUN_CUT = "|".join(f"(?<={c}{{4}})(?={c}{{4}})" for c in _RUNS)
_FREE_CUT = r"(?=[\t-\r ])|(?<=[0-9])(?=[0-9])"
_CUT = regex.compile(rf"(?V1)(?P<free>{_FREE_CUT})|(?P<run>{_RUN_CUT})|(?P<mark>(?<=\p{{M}})(?={_LETTER}))")
_CLUSTER = regex.compile(r"\P{M}\p{M}+$")
MARKS = 32  # looked back over from a cut
_LETTERS = regex.compile(r"\p{L}+")
_LAST_SPACE = regex.compile(r"(?r)[\t-\r ]")


def _plain(text: str) -> str:
    return "".join(c.lower() for c in unicodedata.normalize("NFC", text))


def _tie(text: str, found: regex.Match) -> int | None:
    """How the texts to both sides of a cut are tied; None if it may not be made there.

    Letters next to a cut must stay letters, one for one, when they are normalised; a
    letter and its marks may become one letter, and then the run goes on after them.
    """
    at = found.start()
    if found["run"] is not None:
        around = text[at - 4 : at + 4]
        plain = around if around.isascii() else _plain(around)
        return RUN if around.isascii() or (len(plain) == len(around) and _LETTERS.fullmatch(plain)) else None
    if found["mark"] is not None:
        cluster = _CLUSTER.search(text, max(0, at - MARKS), at)
        return (RUN if _LETTERS.fullmatch(_plain(cluster[0])[-1]) else FREE) if cluster else None
    return FREE


def pieces(text: str, special: regex.Pattern, size: int = PIECE) -> list[tuple[str, int]]:
    """The text in order, each piece with how it is tied to the one before."""
    barred = [m.span() for m in special.finditer(text)]
    cut, at, kind = [], 0, FREE
    while len(text) - at > size:
        found = _LAST_SPACE.search(text, at + size // 2, at + size)
        if found:
            to, next_kind = found.start(), FREE
        else:
            for found in _CUT.finditer(text, at + size):
                to, next_kind = found.start(), _tie(text, found)
                if next_kind is not None and not any(a < to < b for a, b in barred):
                    break
            else:
                break
        cut.append((text[at:to], kind))
        at, kind = to, next_kind
    return [*cut, (text[at:], kind)]


class _Ids(dict):
    """Ids of a word, from the library's model when first asked for."""

    def __init__(self, vocab: Vocabulary):
        self.model = vocab.tokenizer.model
        self.letters = dict(enumerate(vocab.letters))

    def __missing__(self, word: str) -> tuple[int, ...]:
        letters = word if word.isascii() and word.isprintable() else word.encode("utf-8").decode("latin-1").translate(self.letters)
        ids = tuple(t.id for t in self.model.tokenize(letters))
        if len(word) <= HELD_CHARS:
            if len(self) >= HELD_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes texts as the library does; ids of words met before are held."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pattern = regex.compile(WORD_PATTERN)
        self.ids_of = _Ids(vocab).__getitem__
        self.name_of = [vocab.names[i] for i in range(len(vocab.names))].__getitem__

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [self._encoded(t) for t in texts]

    def _encoded(self, text: str) -> np.ndarray:
        if BEYOND.search(text) is None and self.vocab.special.search(text) is None:
            words = self.pattern.findall(text.lower())
            return np.fromiter(chain.from_iterable(map(self.ids_of, words)), dtype=np.uint32)
        return np.array(self.vocab.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        if self.vocab.tokenizer.decoder is None:  # the library then puts blanks between the names
            return " ".join(map(self.name_of, ids.tolist()))
        return self.vocab.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def joined(self, left: np.ndarray, right: np.ndarray, kind: int) -> np.ndarray:
        """Ids of two neighbouring pieces as one."""
        if kind == FREE or not len(left) or not len(right):
            return np.concatenate((left, right))
        suffix, names = self.vocab.suffix, self.vocab.names
        begin = len(left) - 1  # of the word that the left piece ends in
        while begin and not names[int(left[begin - 1])].endswith(suffix) and int(left[begin - 1]) not in self.vocab.specials.values():
            begin -= 1
        end = 1
        while not names[int(right[end - 1])].endswith(suffix):
            end += 1
        a = [names[int(i)] for i in left[begin:]]
        b = [names[int(i)] for i in right[:end]]
        a[-1] = a[-1].removesuffix(suffix)
        reach = 2
        while True:
            from_, to = max(0, len(a) - reach), min(len(b), reach)
            window = list("".join(a[from_:]) + "".join(b[:to]).removesuffix(suffix))
            if to == len(b):
                window[-1] += suffix
            tokens, _ = merged(window, self.vocab.ranks)
            agree_left = from_ == 0 or (from_ < len(a) - 1 and tokens[0] == a[from_])
            agree_right = to == len(b) or tokens[-1] == b[to - 1]
            if agree_left and agree_right:
                break
            reach *= 2
        middle = [self.vocab.tokenizer.token_to_id(t) for t in tokens]
        return np.concatenate((left[: begin + from_], np.array(middle, dtype=np.uint32), right[to:]))

    def tree(self, parts: list[np.ndarray], kinds: list[int]) -> np.ndarray:
        """All pieces as one, neighbours first."""
        while len(parts) > 1:
            pairs = range(0, len(parts) - 1, 2)
            rest = parts[len(parts) - len(parts) % 2 :]
            parts = [self.joined(parts[i], parts[i + 1], kinds[i + 1]) for i in pairs] + rest
            kinds = kinds[::2]
        return parts[0]


def _encoder(content) -> Encoder:
    return per_process(f"encoder {hash(content.value)}", lambda: Encoder(vocabulary(content.value)))


def _packed(ids: list[np.ndarray]) -> pa.Array:
    return pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())


CODED = "n_tokens long, ids binary, decoded string"


def _coded(encoder: Encoder, rest: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [rest, pa.array([len(i) for i in ids], pa.int64()), _packed(ids), pa.array([encoder.decode(i) for i in ids], pa.string())],
        names=["rest", "n_tokens", "ids", "decoded"],
    )


def _whole(content):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                yield _coded(encoder, part.column(0), encoder.encode(part.column(1).to_pylist()))

    return encode


def _cutter(content):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = _encoder(content).vocab.special
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = pieces(text, special)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(found), pa.string()),
                        pa.array(range(len(found)), pa.int32()),
                        pa.array([k for _, k in found], pa.int32()),
                        pa.array([t for t, _ in found], pa.string()),
                    ],
                    names=["key", "piece", "kind", "text"],
                )

    return cut


def _piecewise(content):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _packed(encoder.encode(batch.column(3).to_pylist()))], names=["key", "piece", "kind", "ids"]
            )

    return encode


def _grower(content):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = batch.column(1)[i].as_py()
                ids = encoder.tree([np.frombuffer(p["ids"], dtype="<u4") for p in parts], [p["kind"] for p in parts])
                yield _coded(encoder, batch.column(0).slice(i, 1), [ids])

    return join


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """The columns of `docs` less text, with n_tokens, ids (little-endian unsigned 32-bit) and decoded.

    Short texts take one pass without a shuffle. Equal long texts are cut and encoded
    once, under the SHA-256 of the text, so that copies do not meet in one group.
    """
    content = docs.sparkSession.sparkContext.broadcast(file_content(path))
    own = {"text", "n_tokens", "ids", "decoded"}
    carried = [c for c in docs.columns if c not in own]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(whole_row(carried).alias("rest"), text.alias("text"))
    coded = with_rest(rows, CODED)
    short = rows.filter(F.length("text") <= PIECE).mapInArrow(_whole(content), coded)

    long = rows.filter(F.length("text") > PIECE).withColumn("key", F.sha2("text", 256))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = long.select("key", "text").dropDuplicates(["key"]).mapInArrow(_cutter(content), "key string, piece int, kind int, text string")
    parts = cut.repartition(tasks, "key", "piece").mapInArrow(_piecewise(content), "key string, piece int, kind int, ids binary")
    whole = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("piece", "kind", "ids"))).alias("parts"))
    grown = whole.mapInArrow(_grower(content), f"rest string, {CODED}").withColumnRenamed("rest", "key")
    joined = long.select("key", "rest").join(grown, "key").select("rest", "n_tokens", "ids", "decoded")
    return short.union(joined).select("rest.*", "n_tokens", "ids", "decoded")
