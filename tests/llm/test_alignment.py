import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import alignment
from wardflow.llm.queries import QUERIES

ODD = [
    None, "", " ", "  ", " a", "a  b", "a b ", "▁a", "a▁b", "\n", "\n\n a \n", "a\t \n b", "a;\r\n  b\r c;\r", "\r", ");\r\r x", "x　 y  z", "don't  stop's", "日本 🎉 é",
    "x <s> </s> <|endoftext|>", "<0x0A>", "\x00\x1c \x85\xa0 b", "ﬁ½", "q" * 20_000, "word, " * 20_000, "1234567  89",
]


class Library:
    """Both libraries on whole texts, and every token pair compared by its end."""

    def __init__(self):
        a, b = alignment.default_models()
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        self.char = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        whole = f" {text}".encode()
        a = [(i, bytes(self.char[c] for c in self.a.id_to_token(i))) for i in self.a.encode(f" {text}", add_special_tokens=False).ids]
        b = [(i, self.bytes_b(i)) for i in self.b.encode(text)]
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return [], []
        return a, b

    def groups(self, text):
        """Ids of both sides of each group."""
        a, b = self.tokens(text or "")
        ends_a, ends_b = (np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b))
        found, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_i, to_j = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            found.append(([x for x, _ in a[i:to_i]], [x for x, _ in b[j:to_j]]))
            i, j = to_i, to_j
        return found


@pytest.fixture(scope="module")
def library():
    return Library()


def spelled(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def made(count, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("  \n\r\tthe,;a.'s12é🎉日▁\xa0 Zq") for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_groups_equal_the_libraries(spark, library):
    texts = ODD + made(800) + [d["text"] for d in given("documents")]
    found = rows(alignment.align(documents(spark, texts, extra="'x' AS groups").withColumn("other", F.lit(1))))
    assert len(found) == len(texts)
    for row in found:
        groups = library.groups(texts[row["doc_id"]])
        assert row["groups"] == spelled(groups) and row["other"] == 1
        assert row["a_ids"] == [i for a, _ in groups for i in a] and row["b_ids"] == [i for _, b in groups for i in b]
        assert row["a_ends"] == np.cumsum([len(a) for a, _ in groups], dtype=int).tolist()
        assert row["b_ends"] == np.cumsum([len(b) for _, b in groups], dtype=int).tolist()


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
def test_pieces_of_every_size_give_the_same_overlaps(step):
    rng = random.Random(step)
    for _ in range(300):
        last = rng.randint(1, 30)
        a, b = (np.array(sorted({last, *(rng.randint(1, last) for _ in range(rng.randint(0, 12)))})) for _ in "ab")
        cut_a, cut_b = alignment.cut_merge(a, b, step)
        work = np.diff(cut_a) + np.diff(cut_b)
        assert (work[:-1] == step).all() and work[-1] <= step and cut_a[-1] == len(a) and cut_b[-1] == len(b)
        got = [np.concatenate(x).tolist() for x in zip(*alignment.merge_ends(a, b, step))]
        wanted = []
        for i, end_a in enumerate(a):
            for j, end_b in enumerate(b):
                begins = (a[i - 1] if i else 0, b[j - 1] if j else 0)
                if max(begins) < min(end_a, end_b):
                    wanted.append((i, j, end_a == end_b))
        assert list(zip(*got)) == wanted


def test_small_tables_give_the_same(monkeypatch, library):
    monkeypatch.setattr(alignment, "TABLE_STRETCHES", 3)
    table = alignment.Stretches(*alignment.default_models())
    for text in ["the cat sat on the mat", "the dog", "a\nb c d e f", "the cat"]:
        a, from_a, b, from_b = table.encode([text, "▁", text])
        tokens_a, tokens_b = library.tokens(text)
        assert a[from_a[2] :].tolist() == [i for i, _ in tokens_a] and b[from_b[2] :].tolist() == [i for i, _ in tokens_b]
        assert from_a[1] == from_a[2] and from_b[1] == from_b[2]


def expected(library, texts):
    every = [library.groups(t) for t in texts]
    links = [[(a[-1], b[-1]) for a, b in groups] for groups in every]
    counts = Counter(p for of in links for p in of)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    for groups, of in zip(every, links):
        yield {
            "n_a": sum(len(a) for a, _ in groups),
            "n_b": sum(len(b) for _, b in groups),
            "n_groups": len(groups),
            "n_links": len(of),
            "n_best": sum(counts[p] == highest[p[1]] for p in of),
            "count_sum": sum(counts[p] for p in of),
            "groups_sha256": hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else "",
        }


@pytest.mark.parametrize("links", [1, 700, 1_000_000])
def test_query_with_parts_of_every_size(spark, library, monkeypatch, links):
    monkeypatch.setattr(alignment, "PART_LINKS", links)
    texts = ODD[:15] + ["word, " * 300] + made(60) + [d["text"] for d in given("documents")][:40]
    texts += texts[:30]
    got = rows(QUERIES["op12_alignment"](spark, folder(spark, documents=documents(spark, texts).repartition(3))))
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    wanted = list(expected(library, texts))
    for row in got:
        assert {k: row[k] for k in wanted[0]} == wanted[row["doc_id"]]


def test_other_columns_are_kept(spark, library):
    texts = ["one two", "one two", None, "▁", "three"]
    df = documents(spark, texts, ids=[1, 1, None, 4, 5], extra="doc_id AS part").withColumn("n_best", F.lit("x"))
    got = rows(alignment.score_links(df))
    assert set(got[0]) == {"doc_id", "lang", "source", "n_chars", "part", "n_links", "n_best", "count_sum"}
    links = sorted((r["part"] or 0, r["n_links"], r["n_best"], r["count_sum"]) for r in got)
    wanted = [(w["n_links"], w["n_best"], w["count_sum"]) for w in expected(library, texts)]
    assert links == sorted((i or 0, *w) for i, w in zip([1, 1, None, 4, 5], wanted))


def test_null_ids_and_an_empty_table(spark):
    docs = documents(spark, ["one two", "one two", None], ids=[None, None, None])
    got = rows(QUERIES["op12_alignment"](spark, folder(spark, documents=docs)))
    assert sorted(r["n_links"] for r in got) == [0, 2, 2] and {r["doc_id"] for r in got} == {None}
    assert rows(QUERIES["op12_alignment"](spark, folder(spark, documents=docs.limit(0)))) == []


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        alignment.Stretches(public_tokenizers.path("word_bpe_49k.json"), alignment.default_models()[1])
