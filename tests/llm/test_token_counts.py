import random

import pytest
from tokenizers import Tokenizer

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import token_counts
from wardflow.llm.queries import QUERIES

ODD = [
    None, "", " ", "\n\t", "a", "A  b", "don't STOP 'S", "x_y--z", "12 3²½", "<|endoftext|>", "a<|startoftext|>b<|ENDOFTEXT|>", "é é",
    "ΣΊΣΥΦΟΣ", "İstanbul", "日本 🎉🎉", "\x00\x1c\x85\xa0", "ﬁ ǅ", "q" * 20_000, "word " * 20_000, "!" * 5_000,
]


def library(path=None):
    return Tokenizer.from_file(path or token_counts.default_model())


def expected(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def byte_vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(spark):
    texts = ODD + [d["text"] for d in given("documents")]
    tokenizer = library()
    for row in rows(token_counts.count_tokens(documents(spark, texts, extra="'x' AS n_tokens"))):
        assert row["n_tokens"] == expected(tokenizer, texts[row["doc_id"]])
        assert row["n_bytes"] == len((texts[row["doc_id"]] or "").encode())


def test_every_plain_character_is_split_as_the_library_does():
    counter, tokenizer = token_counts.Counter(token_counts.default_model()), library()
    assert counter.fast
    for c in map(chr, range(0x300)):
        for text in (c, f"a{c}b", c + c, f"1{c}s", f"'{c}"):
            assert counter.count(text) == expected(tokenizer, text), hex(ord(c))


@pytest.mark.parametrize("path", [None, byte_vocabulary()])
def test_made_texts_of_both_vocabularies(path, monkeypatch):
    monkeypatch.setattr(token_counts, "TABLE_WORDS", 500)
    counter, tokenizer = token_counts.Counter(path or token_counts.default_model()), library(path)
    rng = random.Random(7)
    for _ in range(5000):
        text = "".join(rng.choice("abthe 's'TS12_-\t\n\x1cé²ÉΣσ日🎉İ½\xa0́") for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", "", "<|endoftext|>", "<|startoftext|>" + text])
        assert counter.count(text) == expected(tokenizer, text), text


def test_merges_equal_a_search_for_the_lowest_rank():
    merges = token_counts.Counter(token_counts.default_model()).plain.merges

    def plainly(word):
        symbols = [merges.inner[b] for b in word[:-1]] + [merges.last[word[-1]]]
        while True:
            found = [(merges.rules.get(a * merges.size + b), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            found = [(r[0], i, r[1]) for r, i in found if r]
            if not found:
                return len(symbols)
            _, i, new = min(found)
            symbols[i : i + 2] = [new]

    rng = random.Random(1)
    for _ in range(3000):
        word = bytes(rng.choice(b"aaabeinrst\xc3\xa9") for _ in range(rng.randint(1, 30)))
        assert merges.count(word) == plainly(word)


def test_other_kinds_are_refused(tmp_path):
    import json

    with open(token_counts.default_model(), encoding="utf-8") as file:
        told = json.load(file)
    told["pre_tokenizer"] = {"type": "Whitespace"}
    (tmp_path / "odd.json").write_text(json.dumps(told))
    with pytest.raises(ValueError):
        token_counts.Counter(str(tmp_path / "odd.json"))


def test_query(spark):
    tokenizer = library()
    docs = documents(spark, ODD + ODD, ids=[*range(len(ODD)), *[None] * len(ODD)])
    got = rows(QUERIES["op11_token_counts"](spark, folder(spark, documents=docs)))
    assert len(got) == 2 * len(ODD)
    for row in got:
        assert row["over_limit"] == (row["n_tokens"] > 2048)
        if row["doc_id"] is not None:
            assert row["n_tokens"] == expected(tokenizer, ODD[row["doc_id"]])
    assert QUERIES["op11_token_counts"](spark, folder(spark, documents=docs.limit(0))).count() == 0
