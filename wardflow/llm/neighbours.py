"""Nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample: each inner node cuts its points at the median
of their projection on a random direction. Every row is then placed in one leaf of each
tree. A query walks all trees with one shared priority queue, nearest cuts first, and
takes the leaves it reaches; the rows of a leaf are scored there, exactly, against the
queries that reached it, and the best of all leaves are kept.

How many leaves a query reads is measured on the sample: as many as find the wanted part
of the true neighbours of sample points. Clustered vectors need few; vectors spread
evenly in many dimensions need a good part of the forest, by any index.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.batches import ship
from wardflow.operators.ordering import stage

#: Vectors the trees are fitted on; trees; vectors of a leaf (about).
SAMPLE_ROWS = 50_000
TREES = 8
LEAF_ROWS = 1_024
#: Points of the sample in a leaf at least: bounds the forest, however many rows a leaf then holds.
LEAF_POINTS = 16
#: Part of the true neighbours to find, and sample points on which that is measured.
RECALL = 0.95
PROBES = 256
#: A leaf with more vectors than this is read in parts.
PART_ROWS = 4_096


@dataclass
class Forest:
    """Inner nodes of all trees in one table; a child below zero is leaf ``-1 - child``."""

    roots: list[int]
    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root)
            while (inner := np.flatnonzero(node >= 0)).size:
                at = node[inner]
                above = np.einsum("ij,ij->i", x[inner], self.normals[at]) > self.cuts[at]
                node[inner] = self.children[at, above.astype(int)]
            out[:, t] = -1 - node
        return out

    def search(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in the order of the narrowest cut crossed on the way, over all trees."""
        margins = (self.normals @ q - self.cuts).tolist() if len(self.cuts) else []
        queue = [(-np.inf, r) for r in self.roots]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < most:
            crossed, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                continue
            low, high = self.children[node].tolist()
            margin = margins[node]
            near, far = (high, low) if margin > 0 else (low, high)
            heapq.heappush(queue, (crossed, near))
            heapq.heappush(queue, (max(crossed, abs(margin)), far))
        return found


def fit(sample: np.ndarray, leaf_rows: float, trees: int = TREES, seed: int = 11) -> Forest:
    """Cut the sample until nodes have at most ``leaf_rows`` points, or can not be cut."""
    rng = np.random.default_rng(seed)
    roots: list[int] = []
    normals, cuts, children = [], [], []
    leaves = 0

    def leaf() -> int:
        nonlocal leaves
        leaves += 1
        return -leaves

    for _ in range(trees):
        todo = [(np.arange(len(sample)), None)]
        while todo:
            points, link = todo.pop()
            number = None
            if len(points) > max(leaf_rows, 1):
                # Towards one of two points of the node, from the other: follows the data's spread.
                a, b = sample[rng.choice(points, 2, replace=False)]
                normal = (a - b) / (np.linalg.norm(a - b) or 1.0) + rng.normal(size=sample.shape[1]) * 0.05
                along = sample[points] @ normal
                cut = float(np.median(along))
                above = along > cut
                if 0 < above.sum() < len(points):
                    number = len(cuts)
                    normals.append(normal)
                    cuts.append(cut)
                    children.append([0, 0])
                    todo += [(points[~above], (number, 0)), (points[above], (number, 1))]
            number = leaf() if number is None else number
            if link is None:
                roots.append(number)
            else:
                children[link[0]][link[1]] = number
    dims = sample.shape[1] if sample.ndim == 2 else 0
    return Forest(roots, np.array(normals).reshape(-1, dims), np.array(cuts), np.array(children, np.int64).reshape(-1, 2))


def leaves_needed(forest: Forest, sample: np.ndarray, k: int, recall: float, probes: int = PROBES) -> int:
    """How many leaves find ``recall`` of the ``k`` true neighbours of sample points in the sample."""
    if len(sample) < 2:
        return len(forest.roots)
    leaves = forest.leaves_of(sample)
    asked = np.random.default_rng(7).choice(len(sample), min(probes, len(sample)), replace=False)
    places = []
    for i in asked:
        order = forest.search(sample[i], int(leaves.max()) + 1)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        near = sample @ sample[i]
        near[i] = -np.inf
        k_near = np.argpartition(-near, min(k, len(near) - 1))[:k]
        places += place[leaves[k_near]].min(axis=1).tolist()
    return int(np.quantile(places, recall, method="higher")) + 1


def usable(vector: Column) -> Column:
    """Not NULL, all components there and finite, and not the zero vector."""
    big = F.lit(float("inf"))
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that the squares of very large or small components stay in range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, summed alike for every row."""
    q, top = q / np.abs(q).max(), np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _place_in_leaves(vectors: DataFrame, forest, dims: int) -> DataFrame:
    """``(leaf, id, vector, ids)``: each vector once per tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = forest.value.leaves_of(_unit(_matrix(batch.column("vector"), dims)))
                for t in range(leaves.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(leaves[:, t], pa.int64()), *batch.columns], names=["leaf", *batch.schema.names])

    schema = vectors.select(F.lit(0).cast("long").alias("leaf"), "*").schema
    return vectors.mapInArrow(run, schema)


def _reach_leaves(queries: DataFrame, forest, dims: int, most: int) -> DataFrame:
    """``(leaf, query_id, vector)``: the leaves each query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = _unit(_matrix(batch.column("vector"), dims))
                found = [forest.value.search(q, most) for q in units]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                leaf = pa.array(np.array([x for f in found for x in f], np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([leaf, *(c.take(rows) for c in batch.columns)], names=["leaf", *batch.schema.names])

    return queries.mapInArrow(run, queries.select(F.lit(0).cast("long").alias("leaf"), "*").schema)


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    recall: float = RECALL,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """query_id, rank, ``key`` and score of the ``k`` nearest found, for the rows chosen by ``queries``.

    Nearness is the cosine in double precision; ties go to the smaller id; a query is not
    its own neighbour. Vectors that are NULL, zero, or hold NULL or non-finite components,
    and rows without id, take no part. Vectors are compared with those of their own
    length; each length is searched by itself. Rows equal in id and vector count once.
    Equal vectors are searched as one and answered with their ``k + 1`` smallest ids,
    which is all that a query can need of them. An empty table gives an empty one; other
    columns, whatever their names, are left out.
    """
    spark = df.sparkSession
    ship(spark)
    valid = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vector"), queries.alias("asks")).filter(
        F.col("id").isNotNull() & usable(F.col("vector"))
    )
    # -0.0 and 0.0 are one number.
    valid = stage(valid.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0).cast("float"))).withColumn("dims", F.size("vector")))
    empty = spark.createDataFrame([], f"query_id bigint, rank int, `{key}` bigint, score double")
    lengths = [r["dims"] for r in valid.select("dims").distinct().orderBy("dims").collect()]
    searched = [
        _nearest_of_length(valid.filter(F.col("dims") == dims).drop("dims"), dims, k, key, trees, leaf_rows, recall, sample_rows)
        for dims in lengths
    ]
    return reduce(DataFrame.unionByName, searched, empty) if len(searched) != 1 else searched[0]


def _nearest_of_length(
    valid: DataFrame, dims: int, k: int, key: str, trees: int, leaf_rows: int, recall: float, sample_rows: int
) -> DataFrame:
    spark = valid.sparkSession
    # At most k + 1 rows of a vector leave a task, however often it occurs.
    order = Window.partitionBy("vector").orderBy("id")
    smallest = valid.select("vector", "id").withColumn("_n", F.dense_rank().over(order)).filter(F.col("_n") <= k + 1)
    vectors = stage(smallest.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    held = vectors.count()

    share = min(1.0, 0.9 * sample_rows / max(held, 1))
    steps = 1 << 30
    sample = vectors.filter(F.pmod(F.xxhash64("vector"), F.lit(steps)) < int(share * steps) + 1).select("vector").orderBy("vector")
    points = _unit(_matrix(sample.toArrow().column("vector"), dims))
    forest = fit(points, max(leaf_rows * len(points) / max(held, 1), LEAF_POINTS), trees)
    leaves_read = leaves_needed(forest, points, k, recall)
    # At most 2 x trees x sample / points of a leaf nodes, whatever the number of rows.
    shared = spark.sparkContext.broadcast(forest)

    placed = stage(_place_in_leaves(vectors, shared, dims))
    asked = valid.filter("asks").select(F.col("id").alias("query_id"), "vector").distinct()
    reached = _reach_leaves(asked, shared, dims, leaves_read)
    # A leaf with very many vectors is read in parts, by every query that reaches it.
    sizes = placed.groupBy("leaf").agg(F.expr(f"cast(ceil(count(1) / {PART_ROWS}) AS int)").alias("parts"))
    sizes = F.broadcast(stage(sizes))
    part = F.pmod(F.xxhash64("vector"), F.col("parts"))
    rows_of = placed.join(sizes, "leaf").select("leaf", part.cast("int").alias("part"), "vector", "ids")
    asks_of = reached.join(sizes, "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query_id", "vector"
    )

    def score(members: pa.Table, asks: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "score": [], "ids": []}
        if members.num_rows and asks.num_rows:
            x, q = _matrix(members.column("vector"), dims), _matrix(asks.column("vector"), dims)
            ids = members.column("ids").to_pylist()
            first = np.array([i[0] for i in ids])
            rough = _unit(q) @ _unit(x).T
            # The query's own row may be among them: one more than asked for.
            bound = np.partition(rough, max(len(x) - k - 1, 0), axis=1)[:, max(len(x) - k - 1, 0)] - 1e-9
            for query, v, near, least in zip(asks.column("query_id").to_pylist(), q, rough, bound):
                close = np.flatnonzero(near >= least)
                cosines = _cosines(v, x[close])
                for i in np.lexsort((first[close], -cosines))[: k + 1]:
                    out["query_id"].append(query)
                    out["score"].append(float(cosines[i]))
                    out["ids"].append(ids[close[i]])
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))]))

    pairs = rows_of.groupBy("leaf", "part").cogroup(asks_of.groupBy("leaf", "part")).applyInArrow(
        score, "query_id bigint, score double, ids array<bigint>"
    )
    found = pairs.distinct().select("query_id", "score", F.explode("ids").alias("id")).filter("id <> query_id")
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
