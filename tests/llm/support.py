"""Small document tables with the awkward cases every operator has to take."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq

from wardflow.session import fresh_path

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def folder(spark, **tables) -> str:
    """A folder of Parquet tables, as the queries read them."""
    place = fresh_path(spark, "fixture")
    for name, df in tables.items():
        df.write.parquet(f"{place}/{name}.parquet")
    return place


def documents(spark, texts, ids=None, langs=None, extra=""):
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in zip(ids, texts, langs)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.selectExpr("*", extra) if extra else df


def given(name: str, sf: str = "sf0.001"):
    return pq.read_table(os.path.join("/root/testdata", sf, f"{name}.parquet")).to_pylist()


def rows(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


__all__ = ["DOCUMENTS", "documents", "folder", "given", "pa", "rows"]
