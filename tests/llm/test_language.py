import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import language
from wardflow.llm.queries import QUERIES


def grams(text):
    return Counter(int(b) for part in language.buckets(text) for b in part)


def test_scores_match_plain_naive_bayes(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "the house", "das Haus ist da", None, "123"]
    langs = ["en", "de", "en", "de", "en", None]
    model = language.fit(documents(spark, texts, langs=langs))
    counts = {lang: sum((grams(t) for t, x in zip(texts, langs) if x == lang and t), Counter()) for lang in ("de", "en")}
    size = 1 << language.BUCKET_BITS
    for text in ["the dog und", "Katze", "zzz qqq"]:
        logs = {}
        for lang, found in counts.items():
            total = sum(found.values()) + language.SMOOTHING * size
            logs[lang] = math.log(0.5) + sum(n * math.log((found[b] + language.SMOOTHING) / total) for b, n in grams(text).items())
        best = max(logs, key=logs.get)
        score = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        got = model.predict(text)
        assert got[0] == best and abs(got[1] - score) < 1e-3


def test_blocks_do_not_change_the_grams(monkeypatch):
    text = "Straße, été! " * 50
    whole = grams(text)
    monkeypatch.setattr(language, "BLOCK", 7)
    assert grams(text) == whole


def test_held_out_accuracy(spark):
    langs = {d["doc_id"]: d["lang"] for d in given("documents", "sf0.01")}
    got = rows(QUERIES["op10_language"](spark, "/root/testdata/sf0.01"))
    assert len(got) == len(langs) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.98


def test_awkward_texts_and_tables(spark):
    texts = [None, "", "123 !?", "a", "é" * 300_000, "the cat", "the cat", "日本"]
    docs = documents(spark, texts, [1, 2, 3, 4, None, 6, 6, 7], ["en"] * 8, extra="'x' AS lang_pred")
    got = rows(QUERIES["op10_language"](spark, folder(spark, documents=docs)))
    assert len(got) == len(texts)
    found = {r["doc_id"]: r for r in got}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3))
    assert found[4]["lang_pred"] == "en" and found[None]["held_out"]
    unlabelled = documents(spark, texts).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in rows(QUERIES["op10_language"](spark, folder(spark, documents=unlabelled)))} == {"und"}
    assert rows(QUERIES["op10_language"](spark, folder(spark, documents=docs.limit(0)))) == []


def test_the_sample_is_drawn_among_rows_without_id_too(spark):
    """Not all of them or none: the bound holds, and their language is learned."""
    texts = [f"text number {i}" for i in range(1000)]
    docs = documents(spark, texts, [*range(500), *[None] * 500], ["en"] * 500 + ["de"] * 500)
    kept = language.bounded_sample(docs, ["doc_id", "text"], 200)
    assert 100 <= kept.count() <= 200
    model = language.fit(docs, most=200)
    assert model.languages == ["de", "en"] and all(0.25 < p < 0.75 for p in np.exp(model.prior))


def test_numerals_and_fractions_are_no_letters(spark):
    texts = ["½ ² ①", "Ⅷ 12 _", "½a", "ª", "日", "", None]
    assert [language.has_letter(t or "") for t in texts] == [False, False, True, True, True, False, False]
    docs = documents(spark, ["the cat sat on the mat"] * 5 + texts)
    model = language.fit(docs.filter("doc_id < 5"))
    got = {r["doc_id"]: r["lang_pred"] for r in rows(language.identify(docs, model))}
    assert [got[5 + i] for i in range(7)] == ["und", "und", "en", "en", "en", "und", "und"]
    found = {r["doc_id"]: r["lettered"] for r in rows(language.find_letters(docs))}
    assert [found[5 + i] for i in range(7)] == [False, False, True, True, True, False, False]
