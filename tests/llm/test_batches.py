import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from wardflow.llm import batches, sentencepieces


def whole_batches(spark):
    """Bytes of the batch that the text of each row came in."""
    texts = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("word "), 800).alias("text"))

    def work(part: pa.Array) -> list:
        return [pa.array([part.buffers()[2].size] * len(part), pa.int64())]

    sized = batches.add_columns(texts, [StructField("size", LongType())], "text", lambda: work)
    assert sized.count() == 4000
    return [r["size"] for r in sized.select("size").distinct().collect()]


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    session = spark.newSession()
    assert max(whole_batches(session)) <= 2 * batches.BATCH_BYTES


def test_a_bound_of_the_session_is_kept(spark):
    session = spark.newSession()
    session.conf.set(batches.BATCH_SETTING, "200000")
    assert max(whole_batches(session)) <= 400_000
    assert session.conf.get(batches.BATCH_SETTING) == "200000"


def test_a_table_of_words_stays_small_where_all_words_differ():
    table = sentencepieces.WordTable(sentencepieces.default_model())
    tracemalloc.start()
    made = 0
    for i in range(24):
        texts = [" ".join(f"w{i:02d}{j:02d}{k:03d}" for k in range(500)) for j in range(40)]
        ids, offsets, decoded = table.encode(texts)
        made += len(ids)
        assert decoded == texts
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made > 24 * 40 * 500 and peak < 60_000_000
