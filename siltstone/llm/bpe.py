"""Byte-pair vocabularies of the `tokenizers` JSON form, for use inside tasks.

Only texts whose characters all lie under U+0250 are split into words here; for
these the letters, numbers and white space of every Unicode version agree. Other
texts are split by the library itself.
"""

from __future__ import annotations

import heapq
import json
import os

import regex

from siltstone.llm.common import per_process

HELD_WORDS = 200_000
HELD_CHARS = 48

# White space under U+0250, and the word patterns of the two files.
SPACE = r"\t-\r \x85\xa0"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
BEYOND = regex.compile(r"[^\x00-ɏ]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> tuple[list[str], int]:
    """Byte-pair merging: what is left of the symbols, and how many merges were done.

    The pair of lowest rank, leftmost first, is taken from a heap; symbols form a
    doubly linked list. Heap entries whose pair has changed meanwhile are passed over.
    """
    n = len(symbols)
    held: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if held[i] != a or j >= n or held[j] != b:
            continue
        held[i], held[j] = a + b, None
        done += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((a + b, held[k]))) is not None:
                heapq.heappush(heap, (r, i, a + b, held[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get((held[h], a + b))) is not None:
            heapq.heappush(heap, (r, h, held[h], a + b))
    return [s for s in held if s is not None], done


class Vocabulary:
    """Ranks, token names and the library's tokenizer of one file."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parsed = json.loads(content)
        model = parsed["model"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.letters = byte_letters()
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or "(?!)")
        self.names = {i: t for t, i in self.tokenizer.get_vocab(True).items()}

    def symbols(self, word: str) -> list[str]:
        found = [self.letters[b] for b in word.encode("utf-8")]
        if found and self.suffix:
            found[-1] += self.suffix
        return found


def file_content(path: str) -> str:
    """The vocabulary file, read on the driver; a few MB whatever the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def vocabulary(content: str) -> Vocabulary:
    return per_process(f"vocabulary {hash(content)}", lambda: Vocabulary(content))
