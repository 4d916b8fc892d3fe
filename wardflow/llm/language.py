"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from wardflow.llm.batches import add_columns, freeing, ship, slices, strings

#: Learned from at most about this many documents, chosen by a hash of their id and text.
MAX_DOCUMENTS = 20_000
BUCKET_BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
#: Characters scored at a time: bounds the (n-grams x languages) matrix of a task.
BLOCK = 1 << 17

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a text holds a letter: numerals and fractions that count as word characters are none."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into a fold; a row without id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def bounded_sample(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """All rows, or about nine tenths of ``most``, chosen by a hash of the keys; rows equal in them go together."""
    rows = df.count()
    if rows <= most:
        return df
    steps = 1 << 24
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(steps)) < int(0.9 * most / rows * steps))


def buckets(text: str) -> Iterator[np.ndarray]:
    """Hashed 1- to 3-grams of a text, block by block; other characters part words by one space."""
    points = np.frombuffer(f" {_OTHER.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "replace"), np.uint32)
    shift = np.uint32(32 - BUCKET_BITS)
    for low in range(0, len(points), BLOCK):
        part = points[low : low + BLOCK + max(ORDERS) - 1]
        for n in ORDERS:
            # An n-gram belongs to the block it begins in.
            size = min(BLOCK, len(part) - n + 1)
            if size <= 0:
                continue
            h = np.full(size, n * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
            for i in range(n):
                h = (h ^ part[i : i + size]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            yield (h * np.uint32(0xC2B2AE35)) >> shift


@dataclass
class LanguageModel:
    """Log probabilities: one row per bucket, one column per language."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray

    def log_scores(self, text: str) -> np.ndarray:
        total = self.prior.astype(np.float64)
        for found in buckets(text):
            # Sparse: only buckets that occur, each once with its count.
            counts = np.bincount(found, minlength=1 << BUCKET_BITS) if len(found) > 4096 else None
            if counts is None:
                total = total + self.table[found].sum(axis=0, dtype=np.float64)
            else:
                there = np.flatnonzero(counts)
                total = total + counts[there].astype(np.float64) @ self.table[there]
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        scores = self.log_scores(text)
        best = int(np.argmax(scores))
        return self.languages[best], float(1.0 / np.exp(scores - scores[best]).sum())


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", most: int = MAX_DOCUMENTS) -> LanguageModel:
    """Count n-grams per language in tasks, and take logs of the summed counts here.

    ``df`` holds the rows to learn from; NULL labels and NULL or letterless texts teach
    nothing. What comes back is at most one number per language and bucket.
    """
    ship(df.sparkSession)
    usable = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label"))
    sample = bounded_sample(usable.filter("text IS NOT NULL AND label IS NOT NULL"), ["key", "text"], most)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 0):
                for words, lang in zip(strings(part.column(0)), part.column(1).to_pylist()):
                    if not has_letter(words):
                        continue
                    found = sums.setdefault(lang, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                    found[-1] += 1
                    for b in buckets(words):
                        found[:-1] += np.bincount(b, minlength=1 << BUCKET_BITS)
        for lang, found in sums.items():
            there = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(there), pa.string()), pa.array(there, pa.int32()), pa.array(found[there], pa.int64())],
                names=["label", "bucket", "n"],
            )

    counts = sample.select("text", "label").mapInArrow(freeing(count), "label string, bucket int, n bigint")
    rows = counts.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows.column("label").to_pylist()))
    place = {lang: i for i, lang in enumerate(languages)}
    matrix = np.zeros(((1 << BUCKET_BITS) + 1, len(languages)))
    columns = np.fromiter((place[x] for x in rows.column("label").to_pylist()), np.int64, rows.num_rows)
    matrix[rows.column("bucket").to_numpy(), columns] = rows.column("n").to_numpy()
    grams = matrix[:-1] + SMOOTHING
    prior = np.log(matrix[-1] / max(matrix[-1].sum(), 1.0)) if languages else np.zeros(0)
    return LanguageModel(languages, prior, np.log(grams / grams.sum(axis=0)).astype(np.float32))


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the posterior of that language.

    ``und`` and 0 for a NULL text, one without any letter, or a model without languages.
    Columns of ``df`` with these names are replaced; rows stay where they are.
    """
    # languages x buckets floats, whatever the number of documents.
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]

    def start():
        learned = shared.value

        def work(texts: pa.Array) -> list:
            found = [learned.predict(t) for t in texts.to_pylist()]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return work

    return add_columns(df, fields, text, start)


def find_letters(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``lettered``, whether a text holds any letter; false for a NULL text."""

    def work(texts: pa.Array) -> list:
        return [pa.array([bool(t and has_letter(t)) for t in texts.to_pylist()], pa.bool_())]

    return add_columns(df, [StructField("lettered", BooleanType())], text, lambda: work)
