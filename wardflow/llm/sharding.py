"""Shards of near equal bytes by a k-d tree over metadata.

Each node is split at a weighted median along its widest dimension until every leaf
has its share. Medians are found by counting: bytes per bucket of a node's range, then
per bucket of the bucket that holds the median, and so on, for all nodes of a level at
once. Only these counts, a fixed number per node, reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.ordering import stage

BUCKETS = 4096
#: A median may be off by this part of its node's bytes where a finer cut needs more rounds.
TOLERANCE = 1e-4
_ROW_BITS, _TIE_BITS = 20, 62


@dataclass
class Node:
    """A leaf has ``leaves`` 1 and a number; another node a cut ``(dimension, value, tie)``."""

    leaves: int
    number: int = -1
    dimension: str = ""
    value: int = 0
    tie: int = 0
    low: Node | None = None
    high: Node | None = None


def _under(node: Node) -> Column:
    at = F.col(node.dimension)
    return (at < node.value) | ((at == node.value) & (F.col("_tie") < node.tie))


def _place(node: Node) -> Column:
    """Number of the open node or leaf that a row falls into."""
    if node.low is None:
        return F.lit(node.number)
    return F.when(_under(node), _place(node.low)).otherwise(_place(node.high))


def _by_node(values: dict[int, Column]) -> Column:
    out = None
    for number, value in values.items():
        out = F.when(F.col("_node") == number, value) if out is None else out.when(F.col("_node") == number, value)
    return out


@dataclass
class _Search:
    """The range that still holds a node's median: of a dimension first, then of the tie."""

    dimension: str
    low: int
    high: int
    target: float
    before: float = 0.0
    value: int | None = None
    cut: tuple[int, int] | None = None

    @property
    def width(self) -> int:
        return max(-(-(self.high - self.low + 1) // BUCKETS), 1)

    def narrow(self, counts: dict[int, tuple[float, int]], slack: float) -> None:
        """Go into the bucket that holds the target, or settle on one of its edges."""
        total, last = self.before, max(counts)
        for bucket in sorted(counts):
            weight, rows = counts[bucket]
            if total + weight < self.target and bucket != last:
                total += weight
                continue
            start = self.low + bucket * self.width
            single = self.width == 1
            if weight <= slack or rows == 1 or (single and self.value is not None):
                # The nearer edge.
                edge = start if self.target - total <= total + weight - self.target else start + self.width
                self.cut = (edge, -(1 << 62)) if self.value is None else (self.value, edge)
            elif single:
                self.value, self.low, self.high, self.before = start, 0, (1 << _TIE_BITS) - 1, total
            else:
                self.low, self.high, self.before = start, start + self.width - 1, total
            return


def grow_tree(rows: DataFrame, dimensions: Sequence[str], leaves: int) -> Node:
    """Split ``rows`` (``size``, ``_tie`` and whole-number dimensions) into ``leaves`` leaves."""
    root = Node(leaves, 0)
    extent: dict[str, int] = {}
    while True:
        opened = _open(root)
        for i, node in enumerate(opened):
            node.number = i
        todo = {n.number: n for n in opened if n.leaves > 1}
        if not todo:
            break
        placed = rows.withColumn("_node", _place(root)).filter(F.col("_node").isin(*todo))
        ends = [f(d).alias(f"{name}_{d}") for d in dimensions for name, f in (("low", F.min), ("high", F.max))]
        facts = {r["_node"]: r for r in placed.groupBy("_node").agg(F.sum("size").alias("weight"), *ends).collect()}
        searches: dict[int, _Search] = {}
        for number, node in todo.items():
            if number not in facts:
                searches[number] = _Search(dimensions[0], 0, 0, 0.0, cut=(0, 0))
                continue
            fact = facts[number]
            spread = {d: fact[f"high_{d}"] - fact[f"low_{d}"] for d in dimensions}
            extent = extent or {d: max(s, 1) for d, s in spread.items()}
            widest = max(dimensions, key=lambda d: spread[d] / extent[d])
            share = (node.leaves // 2) / node.leaves
            searches[number] = _Search(widest, fact[f"low_{widest}"], fact[f"high_{widest}"], fact["weight"] * share)
        while any(s.cut is None for s in searches.values()):
            open_ones = {n: s for n, s in searches.items() if s.cut is None}
            at = {
                n: F.when(F.col(s.dimension).between(s.low, s.high), F.col(s.dimension) - s.low)
                if s.value is None
                else F.when((F.col(s.dimension) == s.value) & F.col("_tie").between(s.low, s.high), F.col("_tie") - s.low)
                for n, s in open_ones.items()
            }
            width = _by_node({n: F.lit(s.width) for n, s in open_ones.items()})
            counted = (
                placed.withColumns({"_at": _by_node(at), "_width": width})
                .filter(F.col("_at").isNotNull())
                .groupBy("_node", F.expr("_at div _width").alias("bucket"))
                .agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("rows"))
            )
            found: dict[int, dict[int, tuple[float, int]]] = {n: {} for n in open_ones}
            for r in counted.collect():
                found[r["_node"]][int(r["bucket"])] = (float(r["weight"]), r["rows"])
            for n, s in open_ones.items():
                s.narrow(found[n], TOLERANCE * facts[n]["weight"])
        for number, node in todo.items():
            s = searches[number]
            node.dimension, (node.value, node.tie) = s.dimension, s.cut
            half = node.leaves // 2
            node.low, node.high = Node(half), Node(node.leaves - half)
    return root


def _open(node: Node) -> list[Node]:
    return [node] if node.low is None else _open(node.low) + _open(node.high)


def number_slots(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``slot`` 0, 1, 2, … within each group, in parallel: a group may fill many ranges."""
    placed = (
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id())
    )
    placed = stage(placed).withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # One row per group and range: as many as there are tasks and shards together.
    numbered = placed.join(F.broadcast(starts), [group, "_part"])
    return numbered.withColumn("slot", F.col("_start") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_start")


def shard(
    docs: DataFrame,
    id_column: str,
    dimensions: dict[str, Column],
    leaves: int | None = None,
    target_bytes: int | None = None,
    text: str = "text",
) -> DataFrame:
    """id, size, text_crc32, shard and slot of each row of ``docs``.

    ``dimensions`` names whole-number metadata; NULL counts as -1. Give the number of
    leaves, or the bytes a leaf should reach. The size of a row is its text in UTF-8
    (NULL: none) and 8 bytes more. Rows that are equal along a dimension are parted by
    a hash of id and text, and equal rows by their place, so a hot value or thousands of
    copies fill as many shards as their bytes need. Texts stay out of every shuffle.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    mixed = F.xxhash64(F.col(f"`{id_column}`"), F.crc32(body))
    high = F.shiftrightunsigned(mixed, 64 - _TIE_BITS + _ROW_BITS)
    low = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    names = {f"_dim_{name}": F.coalesce(value.cast("long"), F.lit(-1)) for name, value in dimensions.items()}
    rows = stage(
        docs.select(
            F.col(f"`{id_column}`").alias(id_column),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.shiftleft(high, _ROW_BITS).bitwiseOR(low).alias("_tie"),
            *[value.alias(name) for name, value in names.items()],
        )
    )
    if leaves is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        leaves = max(-(-total // target_bytes), 1)
    tree = grow_tree(rows, list(names), leaves)
    placed = rows.select(id_column, "size", "text_crc32", "_tie", _place(tree).cast("int").alias("shard"))
    return number_slots(placed, "shard", [id_column, "_tie"]).drop("_tie")
