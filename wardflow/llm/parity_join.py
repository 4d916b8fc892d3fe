"""N-gram Jaccard join by parity sketches.

A text is the set of its word shingles. Each shingle flips one bit of the text's sketch,
so what two sets share cancels out, and the Hamming distance of two sketches is at
most the symmetric difference d of the sets. A similarity of at least 3/4 allows
d <= (a + b) / 7 for set sizes a and b, which is at most D within a band of sizes.

Blocks. For each band the shingles are dealt into D + 1 blocks by a hash; a block is kept
as the XOR of its shingles' 64-bit hashes. d <= D differences leave at least one block
untouched, so similar sets agree on a block of their band. Blocks without shingles say
nothing and are not joined. A pair at the very threshold still agrees, on average, on 35%
or more of the others, so ``BLOCKS`` of them are enough: a large band uses that many of
its blocks, a small one deals several times. The chance to miss a pair at the threshold
is under 1e-7 (0.65 ** 40), for similarities of 0.8 and more under 1e-11.

Candidates. Sets with one block in common form a bucket. First each is compared with the
leader of its bucket, the first in one of ``ORDERS`` orders, and components are built from
what is verified. Buckets that then still hold several components are compared member by
member, by sketches, in cells of a fixed size. A crowd, a mixed bucket of more than
``CROWD`` members, is dealt anew before: its sets meet in buckets of the shingles that
come first in them, rare ones first, of which similar sets always share one. So what a
passage in many texts brought together parts again, and rows grow with the sets, not with
their pairs. In a bucket beyond a cell, members of its main component meet only the others.

A cell gives the likeliest pairs of components still apart. Where their best one is likely
to be similar, the two count as joined for its further pairs. The pairs are verified; the
cells in which a pair failed that had others left out for it are gone through again
without the failed ones, and give more pairs, until none is left. So every pair of a
bucket is either in one component, ruled out by its sketches or its first shingles, or
verified and found different; none is dropped.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from wardflow.llm.batches import SPACES, add_columns, freeing, mix, ship, words
from wardflow.llm.components import components
from wardflow.llm.decontaminate import BROADCAST_ROWS, text_key
from wardflow.operators.ordering import stage

SHINGLE = 5
#: Similar: SHARE_OF * intersection >= SHARE * union.
SHARE, SHARE_OF = 75, 100
BLOCKS = 40
#: Members of a bucket that are compared in one cell, about.
CELL = 2048
#: A mixed bucket of more members is a crowd: its sets are dealt anew by their rare shingles.
CROWD = 64
#: Sets of crowds in which shingles are counted, at most, and the count from which one is frequent.
SAMPLE = 20_000
FREQUENT = 8
#: Pairs of two components that a cell gives at first, at most, and how many times more after each round.
FIRST_PAIRS = 4
MORE_PAIRS = 8
#: So many pairs are compared one by one, more as arrays of so many words at a time.
FEW_PAIRS = 64
PAIR_WORDS = 1 << 20
#: Orders in which the leaders of buckets are chosen.
ORDERS = 4
#: A pair is likely where its estimated difference is this part of the largest one, or less.
LIKELY = 0.95
#: Bits of a sketch for each shingle, at least: few share a bit, so distances are nearly exact.
SKETCH_BITS = 8
#: A set this small is similar to equal sets only.
ALONE = 2

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _edges() -> np.ndarray:
    """Least sizes of the bands: a band is half as wide again as the one below."""
    edges = [ALONE + 1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] + (edges[-1] + 1) // 2)
    return np.array(edges, np.int64)


BANDS = _edges()


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's set begins."""
    hashes, first = words(texts, SPACES)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(hashes)) - first[:-1][owner]
    # Each shingle by the place of its first word; a short text is one shingle of all its words.
    starts = np.flatnonzero(place <= np.maximum(count[owner] - SHINGLE, 0))
    starts = starts[(count[owner[starts]] >= SHINGLE) | (place[starts] == 0)]
    length = np.minimum(count[owner[starts]], SHINGLE)
    total = length.astype(np.uint64)
    for i in range(SHINGLE):
        inside = i < length
        at = np.minimum(starts + i, max(len(hashes) - 1, 0))
        total = np.where(inside, mix(total * _STEP + hashes[at]), total)
    owner = owner[starts]
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    total, owner = total[new], owner[new]
    return total, np.searchsorted(owner, np.arange(len(count) + 1))


def _xor_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduceat(values, starts) if len(starts) else np.empty(0, np.uint64)


def set_ids(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set: of its size, the sum and the XOR of its hashes."""
    size = np.diff(first)
    some = np.flatnonzero(size)
    mixed = mix(tokens + _STEP)
    out = np.zeros(len(size), np.uint64)
    out[some] = mix(_xor_runs(mixed, first[some]) + mix(np.add.reduceat(mixed, first[some]) if len(some) else mixed) + size[some].astype(np.uint64))
    return out.view(np.int64)


def block_keys(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the blocks of each set for its band, and for the band below where a smaller set may be."""
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    own = np.searchsorted(BANDS, size, "right") - 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for below in (0, 1):
        band = own - below
        high = BANDS[np.maximum(band, 0) + 1] - 1
        there = (size > ALONE) & (band >= 0) & ((below == 0) | (SHARE * size <= SHARE_OF * high))
        blocks = np.where(there, high // 3 + 1, 1)
        deals = np.where(there, -(-BLOCKS // blocks), 0)
        for deal in range(int(deals.max(initial=0))):
            mine = (deal < deals)[owner]
            who = owner[mine]
            h = mix(tokens[mine] ^ mix(np.full(1, 77 + deal, np.uint64)))
            block = ((h >> np.uint64(32)) * blocks[who].astype(np.uint64)) >> np.uint64(32)
            kept = block < BLOCKS
            who, block, h = who[kept], block[kept].astype(np.int64), mix(h[kept])
            code = who * BLOCKS + block
            order = np.argsort(code, kind="stable")
            code, h = code[order], h[order]
            starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.empty(0, np.int64)
            text, block = code[starts] // BLOCKS, code[starts] % BLOCKS
            place = (band[text] * 64 + deal) * BLOCKS + block
            found.append((text, mix(_xor_runs(h, starts) ^ mix(place.astype(np.uint64) + _STEP))))
    text = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
    keys = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.uint64)
    order = np.argsort(text, kind="stable")
    return keys[order].view(np.int64), np.searchsorted(text[order], np.arange(len(size) + 1))


def sketches(tokens: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Parity of each set: at least ``SKETCH_BITS`` bits per shingle, a power of two, 64 at least."""
    size = np.diff(first)
    bits = 1 << np.maximum(np.ceil(np.log2(np.maximum(SKETCH_BITS * size, 1))).astype(np.int64), 6)
    edge = np.concatenate(([0], np.cumsum(bits)))
    owner = np.repeat(np.arange(len(size)), size)
    at = edge[owner] + (tokens & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=edge[-1]) & 1).astype(np.uint8), bitorder="little")
    return [packed[a // 8 : b // 8].tobytes() for a, b in zip(edge, edge[1:])]


def _folded(sketch: int, bits: int, wanted: int) -> int:
    while bits > wanted:
        bits //= 2
        sketch = (sketch >> bits) ^ (sketch & ((1 << bits) - 1))
    return sketch


def _number(sketch: bytes) -> tuple[int, int]:
    return int.from_bytes(sketch, "little"), 8 * len(sketch)


def _ratio(n_a: int, a: tuple[int, int], n_b: int, b: tuple[int, int]) -> float | None:
    """The estimated difference as a part of the largest one allowed; None where sizes or sketches rule a similar pair out.

    Sketches are given as numbers and lengths. Their distance is at most the difference d,
    and where shingles share bits it is less; so a pair that is not ruled out may come above 1.
    """
    if SHARE_OF * min(n_a, n_b) < SHARE * max(n_a, n_b):
        return None
    bits = min(a[1], b[1])
    apart = (_folded(*a, bits) ^ _folded(*b, bits)).bit_count()
    # d = a + b - 2i with SHARE_OF * i >= SHARE * (a + b - i).
    most = (n_a + n_b) * (SHARE_OF - SHARE) / (SHARE_OF + SHARE)
    if apart > most + 1e-9:
        return None
    return -bits / 2 * math.log1p(-2 * apart / bits) / most if 2 * apart < bits else math.inf


def may_be_similar(n_a: int, sketch_a: bytes, n_b: int, sketch_b: bytes) -> bool:
    return _ratio(n_a, _number(sketch_a), n_b, _number(sketch_b)) is not None


def _describe(df: DataFrame, text: str) -> DataFrame:
    """``df`` with n_shingles, set_id, block keys and sketch of its texts."""
    fields = [
        StructField("n_shingles", LongType()),
        StructField("set_id", LongType()),
        StructField("keys", ArrayType(LongType(), False)),
        StructField("sketch", BinaryType()),
    ]

    def work(texts: pa.Array) -> list:
        tokens, first = shingle_sets(texts)
        keys, edges = block_keys(tokens, first)
        return [
            pa.array(np.diff(first), pa.int64()),
            pa.array(set_ids(tokens, first), pa.int64()),
            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(keys, pa.int64())),
            pa.array(sketches(tokens, first), pa.binary()),
        ]

    return add_columns(df, fields, text, lambda: work)


def _sets(df: DataFrame, text: str) -> DataFrame:
    """set_id and the sorted hashes of its shingles."""
    fields = [StructField("set_id", LongType()), StructField("shingles", BinaryType())]

    def work(texts: pa.Array) -> list:
        tokens, first = shingle_sets(texts)
        return [
            pa.array(set_ids(tokens, first), pa.int64()),
            pa.array([tokens[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
        ]

    return add_columns(df, fields, text, lambda: work).select("set_id", "shingles").dropDuplicates(["set_id"])


def _keep_pairs(pairs: DataFrame, test, columns: tuple[str, ...]) -> DataFrame:
    """Pairs ``(a, b)`` whose other columns pass ``test``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [test(*row) for row in zip(*(batch.column(c).to_pylist() for c in columns))]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.mapInArrow(freeing(run), "a bigint, b bigint")


def _similar(a: bytes, b: bytes) -> bool:
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SHARE_OF * both >= SHARE * (len(a) + len(b) - both)


class _Texts:
    """The texts of sets, from which whole sets are made once more where they are wanted."""

    def __init__(self, texts: DataFrame, described: DataFrame):
        #: _key, _check and text of every row; and one row's key for each set.
        self.texts = texts
        self.source = described.filter(f"n_shingles > {ALONE}").groupBy("set_id").agg(F.min(F.struct("_key", "_check")).alias("row"))

    def of(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (one row per set_id, other columns are kept) with ``text``."""
        others = [c for c in wanted.columns if c != "set_id"]
        rows = stage(self.source.join(wanted, "set_id").select("row.*", *others))
        few = rows.count() <= BROADCAST_ROWS
        return self.texts.join(F.broadcast(rows) if few else rows, ["_key", "_check"]).select("text", *others)

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Those of the candidate pairs that are similar, by their whole sets."""
        wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id"))).distinct()
        sets = stage(_sets(self.of(wanted), "text"))
        left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("set_b"))
        return stage(_keep_pairs(pairs.join(left, "a").join(right, "b"), _similar, ("set_a", "set_b")))


def _all_ratios(left: list[tuple], right: list[tuple]) -> Iterator[tuple[int, int, float]]:
    """Places in two lists of (n_shingles, sketch), and `_ratio`, of the pairs not ruled out."""
    if len(left) * len(right) <= FEW_PAIRS:
        numbers = [(n, _number(sketch)) for n, sketch in right]
        for i, (n, sketch) in enumerate(left):
            number = _number(sketch)
            for j, other in enumerate(numbers):
                if (ratio := _ratio(n, number, *other)) is not None:
                    yield i, j, ratio
        return
    for at_a, n_a, whole_a in _by_length(left):
        for at_b, n_b, whole_b in _by_length(right):
            # Similar sizes have sketches of equal length, or one of twice the other's.
            wide, wide_b = whole_a.shape[1], whole_b.shape[1]
            if max(wide, wide_b) > 2 * min(wide, wide_b):
                continue
            a, b = (_halved(whole_a), whole_b) if wide > wide_b else (whole_a, _halved(whole_b)) if wide < wide_b else (whole_a, whole_b)
            bits = 64 * a.shape[1]
            step = max(PAIR_WORDS // b.size, 1)
            for low in range(0, len(a), step):
                apart = np.bitwise_count(a[low : low + step, None] ^ b).sum(-1, dtype=np.int64)
                one, two = n_a[low : low + step, None], n_b
                most = (one + two) * (SHARE_OF - SHARE) / (SHARE_OF + SHARE)
                near = (apart <= most + 1e-9) & (SHARE_OF * np.minimum(one, two) >= SHARE * np.maximum(one, two))
                i, j = np.nonzero(near)
                share = 2 * apart[i, j] / bits
                ratio = np.where(share < 1, -bits / 2 * np.log1p(-np.minimum(share, 0.99)) / most[i, j], np.inf)
                yield from zip(at_a[low + i].tolist(), at_b[j].tolist(), ratio.tolist())


def _by_length(members: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, sizes and sketches, as rows of words, for each length of sketches."""
    lengths = np.array([len(sketch) for _, sketch in members])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        joined = np.frombuffer(b"".join(members[i][1] for i in at), np.uint64).reshape(len(at), -1)
        yield at, np.array([members[i][0] for i in at], np.int64), joined


def _halved(sketch: np.ndarray) -> np.ndarray:
    half = sketch.shape[1] // 2
    return sketch[:, :half] ^ sketch[:, half:]


def _joining_pairs(members: list[tuple], halves: bool, most: int) -> Iterator[tuple[int, int, bool]]:
    """Pairs of a cell that may be similar and join components not joined so far.

    Members are (set_id, component, own, n_shingles, sketch, avoid). Most are in one large
    component and never held against each other. Of each two components the ``most`` likeliest
    pairs are given, the likeliest components first; where their best pair is likely to be
    similar, they count as joined for what follows. The flag says that for such a pair, or
    for more than ``most``, others were left out. A cell of two ``halves`` compares only across them.
    """
    counts = Counter(m[1] for m in members)
    main = min(counts, key=lambda c: (-counts[c], c))
    large = [m for m in members if m[1] == main]
    rest = [m for m in members if m[1] != main]
    met: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    for others in (large, rest):
        for i, j, ratio in _all_ratios([m[3:5] for m in rest], [m[3:5] for m in others]):
            a, b = rest[i], others[j]
            if a[1] == b[1] or (halves and a[2] == b[2]) or (others is rest and j < i):
                continue
            if b[0] not in a[5] and a[0] not in b[5]:
                met.setdefault((min(a[1], b[1]), max(a[1], b[1])), []).append((ratio, min(a[0], b[0]), max(a[0], b[0])))
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (above := parent.get(c, c)) != c:
            parent[c] = c = parent.get(above, above)
        return c

    for (one, two), pairs in sorted(met.items(), key=lambda item: min(item[1])):
        if root(one) != root(two):
            best = heapq.nsmallest(most, pairs)
            joined = best[0][0] <= LIKELY
            for _, a, b in best:
                yield a, b, joined or len(pairs) > most
            if joined:
                parent[root(one)] = root(two)


def _compare_cells(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The joining pairs of all cells of a task; the rows of a cell come in a run."""
    cell, members, out = None, [], {}

    def close() -> None:
        if len(members) > 1:
            for a, b, flag in _joining_pairs(members, cell[1] != cell[2], most):
                out[a, b] = flag or out.get((a, b), False)

    def flush() -> pa.RecordBatch:
        found = [(*pair, flag) for pair, flag in out.items()]
        out.clear()
        kinds = (pa.int64(), pa.int64(), pa.bool_())
        columns = [pa.array([p[i] for p in found], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "partial"])

    names = ("key", "low", "high", "set_id", "component", "own", "n_shingles", "sketch", "avoid")
    for batch in rows:
        for key, low, high, *member, avoid in zip(*(batch.column(c).to_pylist() for c in names)):
            if (key, low, high) != cell:
                close()
                cell, members = (key, low, high), []
            members.append((*member, frozenset(avoid or ())))
        yield flush()
    close()
    yield flush()


def prefixes(tokens: np.ndarray, first: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set, rare ones first: similar sets have one of these in common.

    The order is the same for all sets: by the count of a shingle (0, if not among the sorted
    ``frequent`` ones), then by its hash. Of n shingles a similar set lacks n / 4 at most.
    """
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    count = np.zeros(len(tokens), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        count = np.where(frequent[at] == tokens, counts[at], 0)
    order = np.lexsort((tokens, count, owner))
    wanted = size * (SHARE_OF - SHARE) // SHARE_OF + 1
    taken = np.arange(len(tokens)) - first[:-1][owner] < wanted[owner]
    return tokens[order][taken].view(np.int64), np.concatenate(([0], np.cumsum(np.minimum(wanted, size))))


def _frequent(texts: _Texts, crowd: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur in many of the sets ``crowd``, sorted, and their counts in a sample.

    The sample (by hash, about ``SAMPLE`` sets) bounds what is counted and what the driver
    holds. It only settles which shingles are taken to be rare.
    """

    def work(batch: pa.Array) -> list:
        tokens, first = shingle_sets(batch)
        return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(tokens.view(np.int64), pa.int64()))]

    some = crowd.select("set_id").filter(F.pmod(F.xxhash64("set_id"), F.lit(crowd.count())) < SAMPLE)
    listed = add_columns(texts.of(some), [StructField("tokens", ArrayType(LongType(), False))], "text", lambda: work)
    counted = listed.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    found = counted.filter(F.col("n") >= FREQUENT).toArrow()
    tokens, counts = (found.column(c).to_numpy() for c in ("token", "n"))
    order = np.argsort(tokens.view(np.uint64))
    return tokens.view(np.uint64)[order], counts[order]


def _by_rare_shingles(texts: _Texts, crowd: DataFrame) -> DataFrame:
    """(key, set_id, component) for the first shingles of the sets ``crowd`` (set_id, component)."""
    frequent, counts = _frequent(texts, crowd)

    def work(batch: pa.Array) -> list:
        tokens, first = shingle_sets(batch)
        keys, edges = prefixes(tokens, first, frequent, counts)
        return [
            pa.array(set_ids(tokens, first), pa.int64()),
            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(keys, pa.int64())),
        ]

    fields = [StructField("set_id", LongType()), StructField("keys", ArrayType(LongType(), False))]
    listed = add_columns(texts.of(crowd), fields, "text", lambda: work).dropDuplicates(["set_id"])
    return listed.select(F.explode("keys").alias("key"), "set_id", "component")


def _mixed(named: DataFrame) -> DataFrame:
    """(key, size) of the buckets in which several components meet."""
    sizes = named.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("size"))
    return stage(sizes.filter("_low <> _high").select("key", "size"))


def _dealt(named: DataFrame, mixed: DataFrame) -> DataFrame:
    """Members of mixed buckets with the cells (key, low, high) in which they are compared.

    A bucket of ``CELL`` members is one cell. Of a larger one the main component, which is
    not compared with itself, and the others are cut in parts; a cell holds two parts, or
    one part of the others.
    """
    small = named.join(mixed.filter(F.col("size") <= CELL), "key").select("key", "set_id", *[F.lit(0).alias(c) for c in ("own", "low", "high")])
    large = stage(named.join(mixed.filter(F.col("size") > CELL), "key").select("key", "set_id", "component"))
    if large.isEmpty():
        return small
    parts = large.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("size"))
    cuts = stage(
        main.select(
            "key",
            F.col("main.component").alias("main"),
            F.ceil(F.col("main.n") / CELL).cast("int").alias("mains"),
            F.ceil((F.col("size") - F.col("main.n")) / CELL).cast("int").alias("others"),
        )
    )
    in_main, part = F.col("component") == F.col("main"), F.xxhash64("set_id", "key")
    spread = (
        large.join(cuts, "key")
        .withColumn("own", F.when(in_main, F.pmod(part, "mains")).otherwise(F.col("mains") + F.pmod(part, "others")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.when(in_main, F.col("mains")).otherwise(F.lit(0)), F.col("mains") + F.col("others") - 1)))
        .select("key", "set_id", "own", F.least("own", "_other").alias("low"), F.greatest("own", "_other").alias("high"))
    )
    return small.union(spread)


def _cells(texts: _Texts, members: DataFrame, found: DataFrame) -> DataFrame:
    """Cells of the buckets that hold several components; crowds are dealt anew by rare shingles."""
    named = stage(_with_components(members, found))
    mixed = _mixed(named)
    few = _dealt(named, mixed.filter(F.col("size") <= CROWD))
    crowds = mixed.filter(F.col("size") > CROWD)
    if crowds.isEmpty():
        return stage(few)
    crowd = stage(named.join(crowds, "key").select("set_id", "component").distinct())
    rare = stage(_by_rare_shingles(texts, crowd))
    return stage(few.union(_dealt(rare, _mixed(rare))))


def _with_components(rows: DataFrame, found: DataFrame) -> DataFrame:
    named = rows.join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
    return named.select(*rows.columns, F.coalesce("component", "set_id").alias("component"))


def _compared(cells: DataFrame, held: DataFrame, found: DataFrame, failed: DataFrame, most: int) -> DataFrame:
    """Candidate pairs (a, b, partial) of the cells, with all that is known of their members."""
    avoid = stage(failed.groupBy(F.col("a").alias("set_id")).agg(F.collect_set("b").alias("avoid")))
    known = held.join(avoid, "set_id", "left")
    dealt = cells.join(stage(_with_components(known, found)), "set_id").repartition("key", "low", "high")
    rows = dealt.sortWithinPartitions("key", "low", "high", "set_id").select(
        "key", "low", "high", "set_id", "component", "own", "n_shingles", "sketch", "avoid"
    )
    pairs = rows.mapInArrow(freeing(lambda batches: _compare_cells(batches, most)), "a bigint, b bigint, partial boolean")
    return stage(pairs.groupBy("a", "b").agg(F.max("partial").alias("partial")))


def _still_apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets are in different components."""
    for end in ("a", "b"):
        to = found.select(F.col("node").alias(end), F.col("component").alias(f"_of_{end}"))
        pairs = pairs.join(to, end, "left").withColumn(f"_of_{end}", F.coalesce(f"_of_{end}", end))
    return stage(pairs.filter("_of_a <> _of_b").select("a", "b"))


def _holding(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those cells that hold both sets of one of the pairs."""
    cell = ["key", "low", "high"]
    left = cells.select(*cell, F.col("set_id").alias("a")).join(pairs.select("a", "b"), "a")
    right = cells.select(*cell, F.col("set_id").alias("b"))
    return stage(cells.join(left.join(right, [*cell, "b"]).select(*cell).distinct(), cell, "left_semi"))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """_key, _check, id, n_shingles, component_id and _component for every row of ``df``.

    Words are lower-cased (A-Z) and parted by ASCII white space. A set holds the distinct
    runs of five words, or all words of a shorter text as one; NULL, empty and wordless
    texts have an empty set and are linked with nothing. Rows with equal sets are one
    member of the join. The component is the smallest id that links lead to; ids may
    repeat or be NULL (a component of NULL ids only is NULL). So it does not name one:
    ``_component`` does, the smallest set of the component, NULL for an empty set.
    """
    ship(df.sparkSession)
    whole = F.col(f"`{text}`").alias("text")
    texts = df.select(F.col(f"`{id_column}`").alias("id"), whole, *text_key(id_column, text))
    described = stage(_describe(texts, "text").drop("text"))
    joined = described.filter(f"n_shingles > {ALONE}")

    keyed = joined.select(F.explode("keys").alias("key"), "set_id")
    # The copies of a set leave a task as one row per block. Leaders are the first by
    # their ids with some bits turned, and which bits depends on the block.
    turn = F.xxhash64(F.pmod(F.col("key"), F.lit(ORDERS)))
    turned = F.col("set_id").bitwiseXOR(turn)
    buckets = keyed.groupBy("key").agg(F.min(turned).alias("first"), F.max(turned).alias("last"))
    shared = stage(buckets.filter("first <> last").select("key", F.col("first").bitwiseXOR(turn).alias("leader")))
    members = stage(keyed.join(shared, "key").distinct())
    sizes = joined.groupBy("set_id").agg(F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch"))
    held = stage(sizes.join(members.select("set_id").distinct(), "set_id"))

    def side(name: str) -> DataFrame:
        return held.select(F.col("set_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    whole_texts = _Texts(texts, described)
    leaders = members.filter("set_id <> leader").select(F.least("set_id", "leader").alias("a"), F.greatest("set_id", "leader").alias("b"))
    sides = leaders.distinct().join(side("a"), "a").join(side("b"), "b")
    given = stage(_keep_pairs(sides, may_be_similar, ("n_a", "s_a", "n_b", "s_b")))
    links = whole_texts.verify(given)
    failed = stage(given.join(links, ["a", "b"], "left_anti"))
    found = components(links)
    cells = _cells(whole_texts, members.drop("leader"), found)
    most = FIRST_PAIRS
    while True:
        given = _compared(cells, held, found, failed, most)
        if given.isEmpty():
            break
        links = whole_texts.verify(given)
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))
        wrong = stage(given.join(links, ["a", "b"], "left_anti"))
        # Only where one of these is held was anything left out that may still join components.
        again = _still_apart(wrong.filter("partial"), found)
        if again.isEmpty():
            break
        failed = stage(failed.union(wrong.select("a", "b")))
        cells = _holding(cells, again)
        most *= MORE_PAIRS

    classes = described.filter("n_shingles > 0").groupBy("set_id").agg(F.min("id").alias("least"))
    named = classes.join(found.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = stage(named.join(smallest, "component").select("set_id", "component_id", F.col("component").alias("_component")))
    rows = described.select("_key", "_check", "id", "n_shingles", "set_id")
    some = rows.filter("n_shingles > 0").join(of_set, "set_id").drop("set_id")
    alone = rows.filter("n_shingles = 0").drop("set_id").withColumns({"component_id": F.col("id"), "_component": F.lit(None).cast("bigint")})
    return some.unionByName(alone).withColumnRenamed("id", id_column)


def keep_one_of_each(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` (all columns): of each component the one with the smallest id.

    Rows with an empty set are groups of their own and all stay; of rows equal in id and
    text one stays.
    """
    found = stage(near_duplicates(df, id_column, text).filter("n_shingles > 0"))
    name = F.struct(F.col(id_column).isNull(), id_column, "_key", "_check")
    kept = found.groupBy("_component").agg(F.min(name).alias("kept")).select("kept._key", "kept._check")
    counted = found.groupBy("_key", "_check").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    # Rows to drop, and kept ones that occur more than once: the few, not the many.
    marked = counted.join(kept.withColumn("kept", F.lit(True)), ["_key", "_check"], "left")
    marked = stage(marked.filter("kept IS NULL OR repeated").select("_key", "_check", F.col("kept").isNotNull().alias("_once")))
    few = marked.count() <= BROADCAST_ROWS
    rows = df.select(F.struct("*").alias("_row"), *text_key(id_column, text)).join(
        F.broadcast(marked) if few else marked, ["_key", "_check"], "left"
    )
    plain = rows.filter("_once IS NULL").select("_row.*")
    once = rows.filter("_once").dropDuplicates(["_key", "_check"]).select("_row.*")
    return plain.unionByName(once)
