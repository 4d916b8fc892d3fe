"""Licence notices: exact seeds propose places, bounded-error matching verifies them.

A notice with at most k edits is cut into k + 1 seeds; k edits can not touch all of
them, so one occurs exactly. An Aho-Corasick automaton finds the seeds of all notices
in one pass over the words of a text, and the regex library looks for the notice
with at most k edits around each of them.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wardflow.llm.batches import NOT_WORD, add_columns, strings

_WORDS = bytes(0x20 if NOT_WORD[i] and not 0x41 <= i <= 0x5A else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))


@dataclass(frozen=True)
class Notice:
    """Lower-case words parted by one space, and the most edits (in characters) allowed."""

    label: str
    words: str
    edits: int = 0


#: The phrases every scan counts exactly.
PHRASES = (
    Notice("mit", "mit license"),
    Notice("apache", "apache license"),
    Notice("gpl", "general public license"),
)

NOTICES = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 6),
    Notice("apache", "licensed under the apache license version 2 0", 3),
    Notice("gpl", "licensed under the gnu general public license", 3),
    Notice("gpl", "this program is free software you can redistribute it and or modify it", 5),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 6),
    Notice("cc-by", "licensed under cc by 4 0", 1),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 1),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", 1),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 5),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
)

SPAN = StructType(
    [
        StructField("label", StringType()),
        StructField("first_word", LongType()),
        StructField("n_words", LongType()),
        StructField("edits", IntegerType()),
        StructField("size", IntegerType()),
    ]
)


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """The notice in edits + 1 parts of about one length, with their places."""
    parts, size = notice.edits + 1, len(notice.words)
    edges = [size * i // parts for i in range(parts + 1)]
    return [(a, notice.words[a:b]) for a, b in zip(edges, edges[1:])]


def best_first(pattern, words: str, low: int, high: int) -> list[tuple[int, int, int]]:
    """``(start, end, edits)`` of matches that do not overlap, in their order.

    Every place is tried, and those with the fewest edits are taken first; what was given up
    for them may still match in what is left between them.
    """
    todo, out = [(low, high)], []
    while todo:
        low, high = todo.pop()
        found = sorted((sum(m.fuzzy_counts), *m.span()) for m in pattern.finditer(words, low, high, overlapped=True))
        taken: list[tuple[int, int, int]] = []
        for edits, start, end in found:
            at = bisect(taken, (start, end, edits))
            if (at == 0 or taken[at - 1][1] < start) and (at == len(taken) or end < taken[at][0]):
                taken.insert(at, (start, end, edits))
        out += taken
        if len(taken) < len(found):
            todo += zip([low, *(t[1] for t in taken)], [*(t[0] for t in taken), high])
    return sorted(out)


class Scanner:
    def __init__(self, phrases: Sequence[Notice], notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.phrases, self.notices = tuple(phrases), tuple(notices)
        places = defaultdict(list)
        for i, notice in enumerate(self.notices):
            for offset, seed in seeds(notice):
                places[seed].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, where in places.items():
            self.automaton.add_word(seed, (len(seed), where))
        if places:
            self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?<= )(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}(?= )", regex.ENHANCEMATCH)
            for n in self.notices
        ]

    def windows(self, words: str) -> dict[int, list[list[int]]]:
        """For each notice, the merged places around its seeds."""
        found: dict[int, list[list[int]]] = defaultdict(list)
        if not len(self.automaton):
            return found
        for last, (size, where) in self.automaton.iter(words):
            for i, offset in where:
                notice, begin = self.notices[i], last - size + 1 - offset
                low = max(begin - notice.edits - 1, 0)
                high = begin + len(notice.words) + notice.edits + 1
                spans = found[i]
                # A longer seed is reported later but may begin earlier.
                while spans and low <= spans[-1][1]:
                    before = spans.pop()
                    low, high = min(low, before[0]), max(high, before[1])
                spans.append([low, high])
        return found

    def scan(self, text: str) -> tuple[int, list[tuple], list[tuple]]:
        """Number of words, exact phrase spans, and verified notice spans."""
        split = text.encode("utf-8", "replace").translate(_WORDS).split()
        if not split:
            return 0, [], []
        words = f" {b' '.join(split).decode('utf-8', 'replace')} "
        base = []
        for phrase in self.phrases:
            wanted, size = f" {phrase.words} ", phrase.words.count(" ") + 1
            at, word, counted = words.find(wanted), 0, 0
            while at >= 0:
                word, counted = word + words.count(" ", counted, at), at
                base.append((phrase.label, word, size, 0, len(phrase.words)))
                at = words.find(wanted, at + 1)
        fuzzy = set()
        for i, spans in self.windows(words).items():
            notice = self.notices[i]
            word, counted = 0, 0
            for low, high in spans:
                # One space on either side, for the look-around.
                for start, end, edits in best_first(self.patterns[i], words, low, min(high + 1, len(words))):
                    word, counted = word + words.count(" ", counted, start), start
                    fuzzy.add((notice.label, word - 1, words.count(" ", start, end) + 1, edits, len(notice.words)))
        return len(split), base, sorted(fuzzy, key=lambda s: (s[1], s[2], s[0]))


def find_notices(
    df: DataFrame, text: str = "text", phrases: Sequence[Notice] = PHRASES, notices: Sequence[Notice] = NOTICES
) -> DataFrame:
    """``df`` with ``n_words``, exact ``phrases`` and fuzzy ``notices`` as arrays of spans.

    Words are runs of ASCII letters and digits and of all other characters beyond
    ASCII, lower-cased A-Z, numbered from 0 over the whole text. NULL and empty texts
    have no words and no spans. Rows stay where they are; columns of ``df`` named like
    the new ones are replaced.
    """
    fields = [
        StructField("n_words", LongType()),
        StructField("phrases", ArrayType(SPAN)),
        StructField("notices", ArrayType(SPAN)),
    ]
    kind = pa.list_(
        pa.struct(
            [
                ("label", pa.string()),
                ("first_word", pa.int64()),
                ("n_words", pa.int64()),
                ("edits", pa.int32()),
                ("size", pa.int32()),
            ]
        )
    )
    names = [f.name for f in SPAN.fields]

    def start():
        scanner = Scanner(phrases, notices)

        def arrow(rows: list[list[tuple]]) -> pa.Array:
            return pa.array([[dict(zip(names, s)) for s in spans] for spans in rows], kind)

        def work(texts: pa.Array) -> list:
            found = [scanner.scan(t) for t in strings(texts)]
            return [pa.array([f[0] for f in found], pa.int64()), arrow([f[1] for f in found]), arrow([f[2] for f in found])]

        return work

    return add_columns(df, fields, text, start)
