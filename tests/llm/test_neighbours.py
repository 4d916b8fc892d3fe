import numpy as np
from pyspark.sql import functions as F

from tests.llm.support import folder, given, rows
from wardflow.llm import neighbours
from wardflow.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(vectors, asks, k=5):
    """Every pair, in double precision; equal rows count once."""
    kept = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[(i, tuple(np.float32(v).tolist()))] = None
    out = {}
    for i, v in kept:
        if not asks(i):
            continue
        best = {}
        for j, w in kept:
            if j != i:
                a, b = np.array(v), np.array(w)
                best[j] = max(best.get(j, -2), float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())))
        out[i] = sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return out


def found(df, key="vec_id"):
    out = {}
    for r in sorted(rows(df), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r[key], r["score"]))
    return out


def test_given_vectors_recall(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in given("embeddings")]
    got, wanted = found(QUERIES["op8_neighbours"](spark, "/root/testdata/sf0.001")), brute(vectors, lambda i: i % 50 == 0)
    assert got.keys() == wanted.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def test_many_leaves_recall_and_scores(spark):
    """Small leaves, so that the queue over all trees decides what is read."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    vectors = [(i, (centres[i % 30] + 0.4 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(1500)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)
    got, wanted = found(neighbours.nearest(df, F.col("vec_id") % 25 == 0, leaf_rows=16)), brute(vectors, lambda i: i % 25 == 0)
    assert got.keys() == wanted.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 5 * len(wanted)
    exact = {(q, i): s for q in wanted for i, s in wanted[q]}
    assert all(abs(s - exact[(q, i)]) < 1e-12 for q in got for i, s in got[q] if (q, i) in exact)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    hot = [0.5, 0.25, -1.0]
    vectors = [
        (0, hot), (50, hot), (1, [1.0, 0.5, -2.0]), (2, None), (100, [0.0, 0.0, 0.0]), (3, [nan, 1.0, 1.0]), (4, [inf, 1.0, 1.0]),
        (5, [None, 1.0, 1.0]), (None, hot), (6, [1.0, 2.0]), (150, [-0.0, 1.0, 0.0]), (7, [0.0, 2.0, 0.0]), (200, [1e-30, 0.0, 0.0]),
        (8, [3e38, 0.0, 0.0]), *[(i, hot) for i in range(300, 340)], (0, hot), (7, [0.0, 2.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).selectExpr("*", "1 AS score", "2 AS ids")
    got = found(QUERIES["op8_neighbours"](spark, folder(spark, embeddings=df)))
    wanted = brute([v for v in vectors if v[1] is None or len(v[1]) == 3], lambda i: i % 50 == 0)
    assert got.keys() == wanted.keys() == {0, 50, 150, 200, 300}
    for q in wanted:
        assert [i for i, _ in got[q]] == [i for i, _ in wanted[q]], q
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in wanted[q]], atol=1e-12)


def test_few_and_no_vectors(spark):
    one = spark.createDataFrame([(0, [1.0], 0)], SCHEMA)
    assert rows(neighbours.nearest(one, F.lit(True))) == []
    assert rows(neighbours.nearest(one.limit(0), F.lit(True))) == []
    two = spark.createDataFrame([(0, [1.0], 0), (9, [-2.0], 0)], SCHEMA)
    assert found(neighbours.nearest(two, F.lit(True))) == {0: [(9, -1.0)], 9: [(0, -1.0)]}


def test_every_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(size=3).tolist()) for i in range(60)] + [(150 + 50 * i, rng.normal(size=2).tolist()) for i in range(4)]
    vectors += [(1000, rng.normal(size=7).tolist())]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).withColumnsRenamed({"label": "rank"}).withColumn("dims", F.lit(9))
    got = found(neighbours.nearest(df, F.col("vec_id") % 50 == 0, k=5))
    wanted = {}
    for size in (2, 3):
        wanted |= brute([(i, v) for i, v in vectors if len(v) == size], lambda i: i % 50 == 0)
    assert {q: [i for i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near] for q, near in wanted.items()}
    assert len(got[150]) == 3 and 1000 not in got
    assert rows(neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0, k=5)) == []
