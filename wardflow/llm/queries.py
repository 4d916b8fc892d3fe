"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from wardflow.llm import (
    alignment,
    conversations,
    decontaminate,
    language,
    licenses,
    neighbours,
    parity_join,
    pii,
    quality,
    sentencepieces,
    sharding,
    token_counts,
    urls,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE]
    base = pii.joined(pii.base_spans(F.col("spans")))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op2_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parity_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id"), 4, 2))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.filter(~language.held_out(F.col("doc_id"), 4, 2)))
    scored = quality.score(docs, model)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_pieces(sentencepieces.encode_decode(docs))


def digest_pieces(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


SHARDS = 24


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dimensions = {
        "source": F.crc32(F.col("source")),
        "lang": F.crc32(F.col("lang")),
        "n_chars": F.col("n_chars"),
        "doc_id": F.col("doc_id"),
    }
    placed = sharding.shard(docs, "doc_id", dimensions, leaves=SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_notices(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.transform("phrases", lambda s: s["label"])
    starts = F.transform("phrases", lambda s: s["first_word"])
    alike = F.transform("notices", lambda s: 1 - s["edits"] / s["size"])
    labels = F.concat(base, F.transform("notices", lambda s: s["label"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max(alike), F.lit(0.0))).alias("score"),
        F.size("notices").cast("long").alias("n_notices"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


#: The rules of the registered query.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.match_rules(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    # Without a rule a page is allowed, unless its URL names no host at all.
    own = F.when(F.col("host") == "", "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id"), 5, 0))
    model = language.fit(docs.filter("NOT held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


#: A document with more tokens does not fit the context the registered query asks for.
TOKEN_LIMIT = 2048


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def _alignment_digests(found: dict[str, pa.Array]) -> list[pa.Array]:
    sizes = [pc.list_value_length(found[c]).cast(pa.int64()) for c in ("a_ids", "b_ids", "a_ends")]
    digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"].to_pylist()]
    return [*sizes, pa.array(digests, pa.string()), found["n_overlaps"]]


ALIGNMENT_FIELDS = [
    StructField("n_a", LongType()),
    StructField("n_b", LongType()),
    StructField("n_groups", LongType()),
    StructField("groups_sha256", StringType()),
    StructField("n_overlaps", LongType()),
]


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.score_links(docs, fields=ALIGNMENT_FIELDS, summary=_alignment_digests)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with one fault in a fifth of their turns or more, chosen by a checksum of id and turn."""
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(texts["conv_id"], F.lit(":"), texts["turn"])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(texts["text"], ".!?", "")).otherwise(texts["text"])
    role = F.when(kind == 4, "user").otherwise(texts["role"])
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.filter(kind != 0)
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = conversations.report(conversations.repair(damage(rows)))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    joined = every.join(told, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    # A conversation that lost all its rows has none of anything.
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_parity_join": op2_parity_join,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_sharding": op5_sharding,
    "op6_licenses": op6_licenses,
    "op7_decontaminate": op7_decontaminate,
    "op8_neighbours": op8_neighbours,
    "op9_urls": op9_urls,
    "op10_language": op10_language,
    "op11_token_counts": op11_token_counts,
    "op12_alignment": op12_alignment,
    "op13_conversations": op13_conversations,
}
