"""Token counts of byte-pair vocabularies, by merges alone.

A word starts as one symbol a byte, kept as a linked list, with its mergeable
neighbours in a heap. The pair of the lowest rank (the leftmost of equal ones) is
merged until none is left; the word has as many tokens as it had symbols, less the
merges. No token is looked up or emitted. A task keeps the counts of distinct words.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from wardflow.llm.batches import add_columns

#: The table of a task starts anew when it holds so many distinct words.
TABLE_WORDS = 400_000
#: A longer word is counted each time it occurs and not kept.
KEPT_CHARS = 64
# A heap entry is one number, rank first, place in the word last.
_PLACES = 1 << 40


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Merges:
    """The merge rules of a vocabulary whose first symbols are bytes."""

    def __init__(self, model: dict):
        ids = model["vocab"]
        if model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-level merges can be counted")
        suffix = model.get("end_of_word_suffix") or ""
        self.size = len(ids)
        self.of_char = byte_chars()
        named = {b: c for c, b in self.of_char.items()}
        # The symbol of each byte inside a word, and of each byte at its end.
        self.inner = [ids[named[b]] for b in range(256)]
        self.last = [ids[named[b] + suffix] for b in range(256)]
        # Of a pair's key: its rank, as the upper part of a heap entry, and its new symbol.
        self.rules: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rules[ids[left] * self.size + ids[right]] = rank * _PLACES, ids[left + right]

    def count(self, word: bytes) -> int:
        """Tokens of one word: its bytes, less the merges that the rules allow."""
        size, rule = self.size, self.rules.get
        symbols = [self.inner[b] for b in word]
        symbols[-1] = self.last[word[-1]]
        tokens = total = len(symbols)
        heap = []
        left = symbols[0]
        for place in range(1, total):
            right = symbols[place]
            if found := rule(left * size + right):
                heap.append(found[0] + place - 1)
            left = right
        if not heap:
            return tokens
        heapify(heap)
        after = list(range(1, total + 1))
        before = list(range(-1, total - 1))
        while heap:
            entry = heappop(heap)
            place = entry % _PLACES
            left, mate = symbols[place], after[place]
            if left < 0 or mate == total:
                continue
            # An entry whose pair has changed since then no longer has its rank.
            found = rule(left * size + symbols[mate])
            if not found or found[0] + place != entry:
                continue
            tokens -= 1
            merged = symbols[place] = found[1]
            symbols[mate] = -1
            beyond = after[place] = after[mate]
            if beyond < total:
                before[beyond] = place
                if found := rule(merged * size + symbols[beyond]):
                    heappush(heap, found[0] + place)
            ahead = before[place]
            if ahead >= 0 and (found := rule(symbols[ahead] * size + merged)):
                heappush(heap, found[0] + ahead)
        return tokens


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Counts(dict):
    """Tokens of each word met, counted when it is first asked for."""

    def __init__(self, merges: Merges, to_bytes):
        super().__init__()
        self.merges, self.to_bytes = merges, to_bytes

    def __missing__(self, word: str) -> int:
        tokens = self.merges.count(self.to_bytes(word))
        if len(word) <= KEPT_CHARS:
            self[word] = tokens
        return tokens

    def trim(self) -> None:
        if len(self) > TABLE_WORDS:
            self.clear()


#: The split pattern of the word vocabulary, in its file's own notation.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Below U+0250, but for U+0130, Python's own classes and lower case agree with the
# library's (a test walks them all), and nothing there is changed by composition.
_PLAIN = re.compile("[\x00-įı-ɏ]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼-¾]+|[0-9²³¹¼-¾]|(?:[^\s\w]|[\x1c-\x1f]|_)+")


class Counter:
    """Counts the tokens of texts as the library does with the same file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.library = Tokenizer.from_file(path)
        if told["model"]["type"] != "BPE" or not _is_byte_level(told["pre_tokenizer"]):
            raise ValueError("only byte-level byte-pair vocabularies can be counted")
        # A special string inside a text is one token and parts the text around it.
        special = sorted((re.escape(t["content"]) for t in told["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(special)) if special else None
        merges = Merges(told["model"])
        self.plain = Counts(merges, str.encode)
        of_char = merges.of_char
        self.mapped = Counts(merges, lambda word: bytes([of_char[c] for c in word]))
        self.fast = _has_known_steps(told)

    def count(self, text: str) -> int:
        special = self.special.findall(text) if self.special else []
        parts = self.special.split(text) if special else [text]
        return len(special) + sum(map(self._count_part, parts))

    def _count_part(self, text: str) -> int:
        if self.fast and _PLAIN.fullmatch(text):
            self.plain.trim()
            return sum(map(self.plain.__getitem__, _WORDS.findall(text.lower())))
        # Other characters: the library's own normalisation and split, then our merges.
        self.mapped.trim()
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return sum(self.mapped[word] for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text))


def _steps(told: dict | None, inner: str) -> list[dict]:
    if told is None:
        return []
    return told[inner] if told["type"] == "Sequence" else [told]


def _is_byte_level(told: dict | None) -> bool:
    steps = _steps(told, "pretokenizers")
    return bool(steps) and steps[-1]["type"] == "ByteLevel" and not steps[-1]["add_prefix_space"]


def _has_known_steps(told: dict) -> bool:
    steps = _steps(told["pre_tokenizer"], "pretokenizers")
    normal = [s["type"] for s in _steps(told["normalizer"], "normalizers")]
    known = {"Regex": WORD_PATTERN}
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == (known, "Removed", True)
        and not steps[1]["use_regex"]
    )


def count_tokens(df: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of its text column.

    A NULL text is an empty one and has neither. Begin, end and padding are not
    counted; special strings inside a text are, as one token each. Very long texts and
    words are counted whole, in memory of their own size. Rows are neither joined nor
    moved, so repeated rows, NULL ids, an empty table and other columns stay as they
    are; columns of ``df`` named ``n_bytes`` or ``n_tokens`` are replaced.
    """
    path = model or default_model()
    fields = [StructField("n_bytes", LongType(), False), StructField("n_tokens", LongType(), False)]

    def start():
        counter = Counter(path)

        def work(texts: pa.Array) -> list:
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            counts = (0 if t is None else counter.count(t) for t in texts.to_pylist())
            return [sizes, pa.array(np.fromiter(counts, np.int64, len(texts)))]

        return work

    return add_columns(df, fields, text, start)
