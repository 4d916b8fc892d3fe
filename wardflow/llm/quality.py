"""Text quality: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField

from wardflow.llm.batches import LOWER, SPACES, add_columns, byte_table, run_hashes, runs, text_bytes

#: Learned from at most this many labelled rows, those with the smallest hashes of their id.
MAX_ROWS = 20_000
TREES, DEPTH, BINS, RATE, MIN_HESSIAN, RIDGE = 80, 4, 64, 0.15, 2.0, 1.0

_LINES = byte_table((0x0A, 0x0A), (0x0D, 0x0D))
#: Classes of bytes whose share of a text is a feature.
CLASSES = {
    "upper": byte_table((0x41, 0x5A)),
    "lower": byte_table((0x61, 0x7A)),
    "digit": byte_table((0x30, 0x39)),
    "space": SPACES,
    "line": _LINES,
    "beyond_ascii": byte_table((0x80, 0xFF)),
    "control": byte_table((0x00, 0x08), (0x0E, 0x1F), (0x7F, 0x7F)),
    "stop": byte_table((0x2E, 0x2E), (0x3F, 0x3F)),
    "comma": byte_table((0x2C, 0x2C), (0x3A, 0x3B)),
    "bang": byte_table((0x21, 0x21)),
    "bar": byte_table((0x7C, 0x7C)),
    "quote": byte_table((0x22, 0x22), (0x27, 0x29)),
    "markup": byte_table((0x3C, 0x3E), (0x5B, 0x60), (0x7B, 0x7E)),
    "symbol": byte_table((0x23, 0x26), (0x2A, 0x2B), (0x40, 0x40)),
}
FEATURES = (
    *(f"share_{name}" for name in CLASSES),
    "log_bytes",
    "log_words",
    "word_bytes",
    "word_spread",
    "log_longest_word",
    "distinct_words",
    "top_word",
    "same_as_before",
    "short_words",
    "log_lines",
    "line_bytes",
    "distinct_lines",
)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; texts begin at ``first`` (with the end as last)."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[first[1:]] - total[first[:-1]]


def _distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct runs, and how often the most frequent one occurs."""
    texts = len(first) - 1
    owner = np.repeat(np.arange(texts), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    top = np.zeros(texts)
    np.maximum.at(top, owner[starts], np.diff(np.append(starts, len(hashes))))
    return np.bincount(owner[starts], minlength=texts).astype(float), top


def features(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text; NULL and empty texts give zeros."""
    raw, offsets = text_bytes(texts)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    columns = [_sums(table[raw], offsets) / size for table in CLASSES.values()]
    begins, ends = runs(raw, offsets, SPACES)
    first = np.searchsorted(begins, offsets)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    length = (ends - begins).astype(float)
    mean = _sums(length, first) / some
    spread = np.sqrt(np.maximum(_sums(length**2, first) / some - mean**2, 0))
    longest = np.zeros(len(words))
    np.maximum.at(longest, np.repeat(np.arange(len(words)), np.diff(first)), length)
    hashes = run_hashes(LOWER[raw], begins, ends)
    distinct, top = _distinct(hashes, first)
    again = np.zeros(len(hashes))
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][np.diff(first) > 0]] = 0
    line_begins, line_ends = runs(raw, offsets, _LINES)
    line_first = np.searchsorted(line_begins, offsets)
    lines = np.diff(line_first).astype(float)
    line_kinds, _ = _distinct(run_hashes(raw, line_begins, line_ends), line_first)
    columns += [
        np.log1p(np.diff(offsets)),
        np.log1p(words),
        mean,
        spread,
        np.log1p(longest),
        distinct / some,
        top / some,
        _sums(again, first) / some,
        _sums(length <= 2, first) / some,
        np.log1p(lines),
        _sums(line_ends - line_begins, line_first) / np.maximum(lines, 1),
        line_kinds / np.maximum(lines, 1),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class BoostedTrees:
    """Complete trees laid out level by level: node i has the children 2i+1 and 2i+2."""

    base: float
    #: trees x inner nodes; a row goes right where its feature is above the threshold.
    feature: np.ndarray
    threshold: np.ndarray
    #: trees x leaves.
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        if trees:
            row, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
            node = np.zeros((len(x), trees), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                above = x[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + above
            total = total + self.value[tree, node - inner].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> BoostedTrees:
    """Second-order boosting on binned features with the logistic loss."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = BoostedTrees(
        float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves))
    )
    if not len(y) or y.min() == y.max():
        return model
    count = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for j in range(count)]
    # Bin b holds the values above edge b-1, up to edge b.
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(count)], axis=1)
    cells = binned + np.arange(count) * BINS
    total = np.full(len(y), model.base)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width = 1 << level
            at = (node[:, None] * (count * BINS) + cells).ravel()
            shape = (width, count, BINS)
            g = np.bincount(at, np.repeat(gradient, count), width * count * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(hessian, count), width * count * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(h < MIN_HESSIAN) | (all_h - h < MIN_HESSIAN)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            chosen, cut = best // BINS, best % BINS
            useful = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            for n in np.flatnonzero(useful):
                if cut[n] < len(edges[chosen[n]]):
                    model.feature[t, width - 1 + n] = chosen[n]
                    model.threshold[t, width - 1 + n] = edges[chosen[n]][cut[n]]
            rows = np.arange(len(y))
            above = x[rows, model.feature[t, width - 1 + node]] > model.threshold[t, width - 1 + node]
            node = 2 * node + above
        g, h = np.bincount(node, gradient, leaves), np.bincount(node, hessian, leaves)
        model.value[t] = -RATE * g / (h + RIDGE)
        total = total + model.value[t, node]
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = MAX_ROWS) -> BoostedTrees:
    """Learn from labelled rows of ``docs``; rows without id, label or match teach nothing.

    Of more than ``most`` labelled ids, those with the smallest hashes are taken, and of
    more than ``most`` rows with these ids (an id may be on many rows), those with the
    smallest hashes of id and statistics: so what is sent here is bounded.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y")).filter("key IS NOT NULL AND y IN (0, 1)")
    taken = known.groupBy("key").agg(F.max("y").alias("y")).orderBy(F.xxhash64("key"), "key").limit(most)
    # At most `most` rows of an id and a number are sent to all tasks.
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(taken), "key")
    fields = [StructField("x", ArrayType(FloatType(), False))]
    found = add_columns(rows, fields, "text", lambda: lambda texts: [_vectors(features(texts))]).select("key", "x", "y")
    found = found.orderBy(F.xxhash64("key", "x"), "key", "x").limit(most).toArrow()
    x = np.asarray(found.column("x").combine_chunks().flatten(), np.float32).reshape(-1, len(FEATURES))
    # In one order, however the rows came in.
    order = np.lexsort((*x.T[:2], found.column("key").to_numpy()))
    return fit_trees(x[order], found.column("y").to_numpy()[order])


def _vectors(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.float32()))


def score(df: DataFrame, model: BoostedTrees, text: str = "text") -> DataFrame:
    """``df`` with ``score``: 0 to 1, higher where label 1 is likelier.

    NULL and empty texts get the score of a text with no statistics. Rows stay where they
    are; a column of ``df`` named ``score`` is replaced.
    """
    # A few thousand numbers, fixed by the number and depth of the trees.
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [StructField("score", DoubleType())]
    return add_columns(df, fields, text, lambda: lambda texts: [pa.array(shared.value.scores(features(texts)), pa.float64())])
