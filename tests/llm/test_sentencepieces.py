import hashlib
import random

import sentencepiece

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import sentencepieces
from wardflow.llm.queries import QUERIES

ODD = [
    None, "", " ", "  ", " a", "a b", "a  b ", "▁a", "a▁b", "▁", "\n", "a\nb", "\n\n a \n", "\n▁\n", "ﬁ½", "a\u0000b", "x <s> </s>",
    "日本 🎉 é", "🎉🎉", "<0x0A>", " x\t y\r\n", "q" * 20_000, "word " * 20_000,
]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())


def test_ids_and_texts_equal_the_library(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice(" \n▁abthe🎉é\t<s>日½") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts = ODD + made + [d["text"] for d in given("documents")]
    sp = library()
    got = rows(sentencepieces.encode_decode(documents(spark, texts, extra="1 AS ids")))
    assert len(got) == len(texts)
    for row in got:
        ids = sp.encode(texts[row["doc_id"]] or "", add_eos=True)
        assert row["ids"] == ids and row["decoded"] == sp.decode(ids)


def test_query_digests_and_empty_table(spark):
    sp = library()
    docs = documents(spark, ODD + ODD)
    for row in rows(QUERIES["op4_sentencepiece"](spark, folder(spark, documents=docs))):
        ids = sp.encode((ODD + ODD)[row["doc_id"]] or "", add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert sentencepieces.encode_decode(docs.limit(0)).count() == 0


def test_a_small_table_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(sentencepieces, "TABLE_WORDS", 3)
    table, sp = sentencepieces.WordTable(sentencepieces.default_model()), library()
    for text in ["the cat sat on the mat", "the dog", "a\nb c d e f", "the cat"]:
        ids, edges, decoded = table.encode([text, text])
        assert ids[edges[1] : edges[2]].tolist() == sp.encode(text) and decoded[0] == text
