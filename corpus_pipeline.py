"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, language, parity_join, pii, sentencepieces
from wardflow.llm.queries import digest_pieces
from wardflow.session import fresh_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can not be told: no letters, or a posterior under one half.

    Where no row names a language there is nothing to tell it by, and only letterless texts go.
    """
    model = language.fit(docs)
    # Packed, no column can clash with a new one; the text itself goes to the tasks once.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    packed = docs.select(others.alias("doc"), "text")
    if model.languages:
        found = language.identify(packed, model)
        kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= 0.5))
    else:
        kept = language.find_letters(packed).filter("lettered")
    return kept.select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates only the document with the smallest id stays."""
    return parity_join.keep_one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of ten words of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.drop_contaminated(docs, items)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; the character count follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(masked.schema["n_chars"].dataType)).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of what is left, as digests per document."""
    return digest_pieces(sentencepieces.encode_decode(docs.select("doc_id", "text")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", mask_personal_data),
    ("pieces", encode_pieces),
]

#: The library's tokenizer has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
