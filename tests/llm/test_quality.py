import numpy as np
import pyarrow as pa

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import quality
from wardflow.llm.queries import QUERIES


def walk(model, x):
    """One row through every tree, node by node."""
    total, inner = model.base, model.feature.shape[1]
    for t in range(len(model.feature)):
        node = 0
        while node < inner:
            node = 2 * node + 1 + int(x[model.feature[t, node]] > model.threshold[t, node])
        total += model.value[t, node - inner]
    return 1 / (1 + np.exp(-total))


def test_flat_traversal_equals_walking_the_trees():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit_trees(x, y, trees=30, depth=3)
    got = model.scores(x)
    np.testing.assert_allclose(got, [walk(model, r) for r in x], rtol=1e-9)
    assert ((got > 0.5) == (y > 0.5)).mean() > 0.95


def test_features_match_plain_counting():
    texts = [None, "", "One one TWO!! three, two.\n\nOne one\nx", "é" * 10, " \n\t ", "a " * 200_000]
    got = quality.features(pa.array(texts))
    assert got.shape == (len(texts), len(quality.FEATURES)) and np.isfinite(got).all()
    at = {name: i for i, name in enumerate(quality.FEATURES)}
    words = texts[2].split()
    assert got[2, at["log_words"]] == np.float32(np.log1p(len(words)))
    assert got[2, at["distinct_words"]] == np.float32(len({w.lower() for w in words}) / len(words))
    assert got[2, at["share_bang"]] == np.float32(2 / len(texts[2]))
    assert got[2, at["distinct_lines"]] == 1 and got[3, at["share_beyond_ascii"]] == 1
    # A text's statistics do not depend on its neighbours.
    alone = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    np.testing.assert_allclose(got, alone, rtol=1e-5, atol=1e-6)


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in rows(QUERIES["op3_quality"](spark, "/root/testdata/sf0.01"))}
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    asked = [(r["quality"], got[r["doc_id"]]) for r in given("labels", "sf0.01") if got[r["doc_id"]]["held_out"]]
    high = [r["score"] for q, r in asked if q == 1]
    low = [r["score"] for q, r in asked if q == 0]
    assert np.mean([a > b for a in high for b in low]) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark):
    texts = [f"word{i} " * (i + 1) for i in range(40)]
    docs = documents(spark, [None, "", *texts], extra="0.5D AS score")
    flat = [(i, int(i % 2)) for i in range(42)]
    one = spark.createDataFrame(flat, "doc_id bigint, quality int")
    held = {r["doc_id"] for r in rows(QUERIES["op3_quality"](spark, folder(spark, documents=docs, labels=one))) if r["held_out"]}
    other = spark.createDataFrame([(i, 1 - q if i in held else q) for i, q in flat], "doc_id bigint, quality int")
    scores = [
        sorted((r["doc_id"], r["score"]) for r in rows(QUERIES["op3_quality"](spark, folder(spark, documents=docs, labels=labels))))
        for labels in (one, other)
    ]
    assert scores[0] == scores[1] and len(scores[0]) == 42


def test_no_labels_and_no_documents(spark):
    docs = documents(spark, ["a", "b"])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert len(rows(QUERIES["op3_quality"](spark, folder(spark, documents=docs, labels=none)))) == 2
    assert rows(QUERIES["op3_quality"](spark, folder(spark, documents=docs.limit(0), labels=none))) == []


def test_the_bound_holds_for_rows_of_one_id(spark, monkeypatch):
    """One labelled id on very many rows: no more than the bound is sent to be learned from."""
    seen = []
    monkeypatch.setattr(quality, "fit_trees", lambda x, y: seen.append(len(y)))
    docs = spark.range(5000).selectExpr("1 AS doc_id", "concat('text ', id % 900) AS text")
    quality.fit(docs, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"), most=10)
    assert seen == [10]


def test_repeated_ids_and_very_long_texts(spark):
    good, bad = "A clear sentence about one thing. " * 3, "xx!! $$ 11 "
    texts = [good, bad] * 30 + [good * 20_000, bad * 50_000, "", None]
    docs = documents(spark, texts, ids=[i // 2 for i in range(len(texts))])
    labels = spark.createDataFrame([(i // 2, i % 2 == 0) for i in range(0, 60, 3)], "doc_id bigint, q boolean").selectExpr("doc_id", "cast(q AS int) AS quality")
    got = rows(quality.score(docs, quality.fit(docs, labels)))
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
