import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import sharding
from wardflow.llm.queries import QUERIES


def check(got, texts, shards=24, slack=None):
    """Sizes and checksums from the texts; gapless slots; bytes of all shards near the mean."""
    assert len(got) == len(texts)
    slots, bytes_of = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        bytes_of[r["shard"]] += r["size"]
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    body = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == body
    if slack is not None:
        mean = sum(bytes_of.values()) / shards
        assert max(abs(bytes_of[s] - mean) for s in range(shards)) <= slack, dict(bytes_of)


def test_given_documents(spark):
    texts = [d["text"] for d in given("documents", "sf0.01")]
    got = rows(QUERIES["op5_sharding"](spark, "/root/testdata/sf0.01"))
    # No cut is off by more than the largest row, and there are five levels of cuts.
    check(got, texts, slack=2 * max(len(t.encode()) for t in texts))


def test_hot_source_copies_and_nulls(spark):
    """A third of the rows equal in every column but the id, some equal in the id as well."""
    rng = np.random.default_rng(4)
    texts = ["same text"] * 900 + ["x" * int(n) for n in rng.integers(0, 60, 1500)] + [None, "", "é" * 50] + ["same"] * 300
    ids = list(range(2403)) + [7] * 150 + [None] * 150
    place = folder(spark, documents=documents(spark, texts, ids, extra="1 AS size").withColumn("source", F.lit(None).cast("string")))
    check(rows(QUERIES["op5_sharding"](spark, place)), texts, slack=300)


def test_target_bytes_and_few_rows(spark):
    df = documents(spark, ["a" * 92] * 10)
    got = rows(sharding.shard(df, "doc_id", {"n_chars": F.col("n_chars")}, target_bytes=250))
    check(got, ["a" * 92] * 10, shards=4, slack=150)
    for texts in ([], ["one"], ["one", None]):
        place = folder(spark, documents=documents(spark, ["z", *texts]).filter("doc_id > 0"))
        check(rows(QUERIES["op5_sharding"](spark, place)), texts)


def test_widest_dimension_is_cut_at_the_weighted_median(spark):
    df = spark.createDataFrame([(i, "x" * (100 if i < 10 else 10), 0, i) for i in range(110)], "doc_id long, text string, a long, b long")
    got = {r["doc_id"]: r["shard"] for r in rows(sharding.shard(df, "doc_id", {"a": F.col("a"), "b": F.col("b")}, leaves=2))}
    weight = np.array([108 if i < 10 else 18 for i in range(110)])
    cut = sum(got[i] == 0 for i in range(110))
    assert [got[i] for i in range(110)] == [0] * cut + [1] * (110 - cut)
    assert abs(weight[:cut].sum() - weight.sum() / 2) == pytest.approx(min(abs(weight[:k].sum() - weight.sum() / 2) for k in range(111)))
