"""URL rules by a sort-merge range join on reversed-host keys.

A host becomes its labels in reverse, each ended by a dot, so all subdomains of a host
lie in one interval of keys. Pages are cut into ranges of equal size by the key (and by
path and id, so that one host, or one URL, may fill many ranges); each rule goes to every
range its interval meets; and each range is swept in key order with a stack of the
rules that hold there.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import ship

#: Rows swept together, about; ranges at most; rows sampled for each range to place its bounds.
#: A range with more rows is dealt into parts, and its rules are copied to each of them.
RANGE_ROWS = 50_000
MOST_RANGES = 4_096
SAMPLE_ROWS = 40
#: Order of two rules with one host and path: the later one here holds.
VERDICTS = ("allow", "block")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty where the URL is NULL or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def _ranges(spark, rows: int) -> int:
    return min(max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS)), MOST_RANGES)


def _bounds(pages: DataFrame, ranges: int, rows: int) -> list[str]:
    """Keys that part the pages into ranges of about one size, from a sample of fixed size per range."""
    steps = 1 << 30
    share = min(1.0, ranges * SAMPLE_ROWS / max(rows, 1))
    kept = pages.filter(F.pmod(F.xxhash64("_place"), F.lit(steps)) < int(share * steps) + 1).select("_place")
    sample = sorted(r[0] for r in kept.collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if len(sample) >= ranges else sorted(set(sample))


class Stack:
    """Rules that hold at the current key, outermost host first."""

    def __init__(self, rules: list[tuple[str, str, str, str]]):
        # (key, host, path, verdict), sorted; a host's rules lie together.
        self.rules, self.next, self.open = rules, 0, []

    def move(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()
        while self.next < len(self.rules) and self.rules[self.next][0] <= key:
            at, host, path, verdict = self.rules[self.next]
            self.next += 1
            if not key.startswith(at):
                continue
            if not self.open or self.open[-1][0] != at:
                self.open.append((at, host, {}))
            paths = self.open[-1][2]
            if path not in paths or VERDICTS.index(verdict) > VERDICTS.index(paths[path]):
                paths[path] = verdict
        self.sizes = [(at, host, paths, sorted({len(p) for p in paths}, reverse=True)) for at, host, paths in self.open]

    def longest(self, path: str) -> tuple[str, str] | None:
        best = None
        for _, host, paths, sizes in self.sizes:
            for size in sizes:
                if size <= len(path) and path[:size] in paths:
                    # Of two equally long rules, the one with the longer host.
                    if best is None or len(host) + size >= len(best[0]):
                        best = (host + path[:size], paths[path[:size]])
                    break
        return best


def _sweep(pages: pa.Table, rules: pa.Table) -> pa.Table:
    pages = pages.sort_by("_key")
    held = zip(*(rules.column(c).to_pylist() for c in ("_key", "rule_host", "rule_path", "rule_verdict")))
    stack, last, found = Stack(sorted(held)), None, []
    for key, path in zip(pages.column("_key").to_pylist(), pages.column("path").to_pylist()):
        if key != last:
            stack.move(key)
            last = key
        found.append(stack.longest(path) if key else None)
    kept = pages.drop_columns(["_key", "_range", "_part"])
    for i, name in enumerate(("rule", "rule_verdict")):
        kept = kept.append_column(name, pa.array([f[i] if f else None for f in found], pa.string()))
    return kept


def match_rules(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, the longest fitting ``rule`` and ``rule_verdict`` (NULL: none).

    ``rules`` has the columns host (lower case), path and verdict (allow or block) and may
    be of any size. A rule fits its host and all subdomains where the page's path starts
    with the rule's; the longest host and path win. NULL or malformed URLs fit no rule.
    Rows are neither joined nor merged, so repeated rows stay; columns of ``pages`` named
    like the new ones are replaced.
    """
    spark = pages.sparkSession
    ship(spark)
    new = {"host", "path", "rule", "rule_verdict", "_key", "_range", "_part", "_place"}
    kept = [c for c in pages.columns if c not in new]
    host, path = host_and_path(F.coalesce(F.col(f"`{url}`"), F.lit("")))
    tie = F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in kept]))
    keyed = (
        pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
        .withColumn("_key", host_key(F.col("host")))
        .withColumn("_place", F.concat_ws("\0", "_key", F.left("path", F.lit(100)), tie))
    )
    rows = pages.count()
    ranges = _ranges(spark, rows)
    parts = max(-(-rows // (ranges * RANGE_ROWS)), 1)
    bounds = _bounds(keyed, ranges, rows)
    # One short string per range: fixed by the number of ranges, never by rows of a key.
    shared = spark.sparkContext.broadcast(bounds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(shared.value, p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int32())], names=[*batch.schema.names[:-1], "_range"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            first = [bisect_right(shared.value, k) for k in keys]
            last = [bisect_right(shared.value, k[:-1] + "/") for k in keys]
            row = [i for i, (a, b) in enumerate(zip(first, last)) for _ in range(a, b + 1)]
            part = pa.array([r for a, b in zip(first, last) for r in range(a, b + 1)], pa.int32())
            taken = [pc.take(c, pa.array(row, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*taken, part], names=[*batch.schema.names, "_range"])

    named = rules.filter("host IS NOT NULL AND path IS NOT NULL AND host <> ''").select(
        host_key(F.col("host")).alias("_key"),
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    )
    dealt = F.pmod(F.xxhash64("_place"), F.lit(parts)).cast("int").alias("_part")
    ready = keyed.select(*keyed.drop("_place").columns, dealt, "_place")
    placed = ready.mapInArrow(place, ready.drop("_place").withColumn("_range", F.lit(0)).schema)
    copies = named.mapInArrow(spread, named.withColumn("_range", F.lit(0)).schema)
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    out = keyed.drop("_place", "_key").withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
    return placed.groupBy("_range", "_part").cogroup(copies.groupBy("_range", "_part")).applyInArrow(_sweep, out.schema)
