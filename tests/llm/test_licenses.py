import re

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import licenses
from wardflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    words = WORD.findall(lower(text))
    found = []
    for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
        wanted = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return len(words), sorted(found)


TEXTS = [
    None,
    "",
    "...",
    "Released under the MIT License. mit license mit license",
    "MIT LICENSE apache\n\nlicense General-Public_License ÄMIT license ſ K",
    "Relesed under the MIT Licence",
    "Licenced under the Apache Licens, Version 2.0!",
    "Licensed under CC BY-NC 4.0.",
    "permission is hereby granted, free of charge to any persn obtainng a copy of this software",
    "word " * 40_000 + "released under the mit license",
    "emit license",
]


def test_base_places_match_brute_force(spark):
    texts = TEXTS + [d["text"] for d in given("documents")]
    place = folder(spark, documents=documents(spark, texts, extra="7 AS n_words"))
    got = rows(QUERIES["op6_licenses"](spark, place))
    assert len(got) == len(texts)
    for row in got:
        n, found = brute(texts[row["doc_id"]])
        assert (row["n_words"], row["n_base"]) == (n, len(found)), row
        assert row["first_word"] == (found[0][0] if found else None)
        assert row["last_word"] == (found[-1][0] if found else None)
        assert row["base_labels"] == ",".join(sorted({f[1] for f in found}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] == 1 or not found)


def test_fuzzy_spans(spark):
    got = {r["doc_id"]: r for r in rows(licenses.find_notices(documents(spark, TEXTS)))}
    spans = {i: [(s["label"], s["first_word"], s["n_words"], s["edits"]) for s in got[i]["notices"]] for i in got}
    assert spans[5] == [("mit", 0, 5, 2)]
    assert [s[0] for s in spans[6]] == ["apache"] and spans[6][0][3] == 2
    assert spans[7] == [("cc-by-nc", 0, 7, 0)]
    assert spans[8] == [("mit", 0, 16, 2)]
    assert spans[9] == [("mit", 40_000, 5, 0)]
    assert spans[0] == spans[1] == spans[10] == []


def test_windows_find_all_that_a_full_search_finds():
    """Pigeonhole: k + 1 seeds lose no occurrence with at most k edits."""
    import random

    random.seed(3)
    scanner = licenses.Scanner((), licenses.NOTICES)
    for notice, pattern in zip(licenses.NOTICES, scanner.patterns):
        for _ in range(20):
            chars = list(notice.words)
            for _ in range(random.randint(0, notice.edits)):
                i = random.randrange(1, len(chars) - 1)
                chars[i : i + 1] = random.choice(["", "x", chars[i] + "q"])
            words = " ".join(f"ab cd {''.join(chars)} ef".split())
            whole = pattern.search(f" {words} ")
            labels = [s[0] for s in scanner.scan(words)[2]]
            assert whole is None or notice.label in labels, (notice, words)


def test_inexact_notices_in_a_row_before_an_exact_one():
    scanner = licenses.Scanner((), licenses.NOTICES)
    line = "licenced under the apache license version 2 0"
    exact = line.replace("licenced", "licensed")
    for lines in ([line] * 5 + [exact], [exact] + [line] * 3, [line, exact, line], [line] * 2 + [exact] * 2 + [line]):
        found = [(s[0], s[1], s[2], s[3]) for s in scanner.scan("\n".join(lines))[2]]
        assert found == [("apache", 8 * i, 8, int(x == line)) for i, x in enumerate(lines)], lines
    # A part of a notice before an exact one does not hide it either.
    gpl = "licensed under the gnu general public"
    assert [s[1:4] for s in scanner.scan(f"{gpl} {gpl} license")[2]] == [(6, 7, 0)]


def test_empty_table(spark):
    assert licenses.find_notices(documents(spark, ["a"]).limit(0)).count() == 0
