import hashlib

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.support import documents, folder, given, rows
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_parity_join import brute as groups
from tests.llm.test_pii import brute as spans
from tests.llm.test_sentencepieces import library
from wardflow.llm import language


def brute(docs, items, model):
    """The stages, one document at a time."""
    kept = []
    for d in docs:
        found, score = model.predict(d["text"])
        if found != "und" and score >= 0.5:
            kept.append(d)
    least = groups([d["text"] for d in kept], [d["doc_id"] for d in kept])
    kept = [d for d, (n, c) in zip(kept, least) if n == 0 or c == d["doc_id"]]
    hit = contamination([d["text"] for d in kept], items)
    kept = [d for d, (_, n, _) in zip(kept, hit) if n == 0]
    sp, out = library(), {}
    for d in kept:
        text, end = "", 0
        for start, _, stop, kind in spans(d["text"]):
            if start < end:
                # An overlap: the first span grows.
                end = max(end, stop)
                continue
            text, end = text + d["text"][end:start] + f"[{kind.upper()}]", stop
        ids = sp.encode(text + d["text"][end:], add_eos=True)
        out[d["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    return out


def test_run_matches_the_stages_one_by_one(spark):
    docs = given("documents", "sf0.01")[:500]
    items = [(b["item_id"], b["text"]) for b in given("benchmark", "sf0.01")]
    df = spark.createDataFrame([tuple(d.values()) for d in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    place = folder(spark, documents=df, benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in rows(corpus_pipeline.run(spark, place))}
    wanted = brute(docs, items, language.fit(df))
    assert got == wanted and 0 < len(got) < len(docs)


def test_stages_keep_the_columns_and_take_awkward_rows(spark):
    texts = [None, "", "!!", "plain words in a line of text", "plain words in a line of text", "mail me at a@b.com please now", "x"]
    df = documents(spark, texts, [1, 2, 3, 4, 5, None, 6], extra="'mine' AS spans").withColumns({"score": F.lit(9), "_key": F.lit(0)})
    place = folder(spark, documents=df, benchmark=spark.createDataFrame([(1, None)], "item_id bigint, text string"))
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, place)
        assert docs.columns == df.columns
    left = rows(docs)
    assert {r["spans"] for r in left} == {"mine"} and {r["score"] for r in left} == {9}
    assert sorted((r["text"], r["n_chars"]) for r in left) == [
        ("mail me at [EMAIL] please now", 29), ("plain words in a line of text", 29), ("x", 1),
    ]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, place).count() == 3
    empty = folder(spark, documents=df.limit(0), benchmark=spark.createDataFrame([], "item_id bigint, text string"))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_documents_without_any_language_are_kept(spark):
    texts = ["plain words in a line of text", "other words", "été", "123 !?", "", None]
    df = documents(spark, texts, [1, 2, None, 4, 5, 6], [None] * 6, extra="'mine' AS lettered")
    kept = corpus_pipeline.keep_known_languages(spark, df, "")
    assert kept.columns == df.columns and sorted(r["text"] for r in rows(kept)) == sorted(texts[:3])
