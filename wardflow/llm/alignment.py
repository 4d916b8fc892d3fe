"""Alignment of the tokens of two vocabularies over the same bytes, and counts of linked ids.

The ends of both tokenizers' tokens are merged. Diagonals of the merge, at equal
distances, are cut by binary search, so each piece has equal work however long a text
is; a piece finds, alone, which tokens overlap, and an end that both sides share closes
a group. Where a shared end falls on a cut, the two pieces beside it are stitched.

Both tokenizers are asked once for each distinct stretch of white space and what
follows it: neither joins anything across the start of such a stretch. (Where the
pieces of a vocabulary end in some white space, such as a carriage return, no stretch
starts there.)
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wardflow.llm.batches import add_columns, freeing, lists, ship, slices, strings
from wardflow.llm.token_counts import byte_chars
from wardflow.session import fresh_path

MARK = "▁"
#: The table of a task starts anew when it holds so many distinct stretches or characters.
TABLE_STRETCHES = 300_000
TABLE_CHARS = 10_000_000
#: Stretches of one call of the first tokenizer.
ASKED = 1000
#: Merge steps of a piece.
PIECE = 1 << 16
#: Linked token pairs of a part: what one task holds of the documents at a time, beyond one text.
PART_LINKS = 500_000
#: Bytes of texts that are aligned at a time, or one longer text.
SLICE_BYTES = 500_000

# Unicode's White_Space characters: those the byte-level split calls \s.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def default_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# Merging ------------------------------------------------------------------------------


def cut_merge(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a merge of two sorted arrays, ``a`` first among equals, is cut every ``step`` steps.

    One binary search along each diagonal, all diagonals at once.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, step), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[diagonal[open_] - 1 - middle]
        low[open_[first]] = middle[first] + 1
        high[open_[~first]] = middle[~first]
    return low, diagonal - low


def merge_piece(a: np.ndarray, b: np.ndarray, cut: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens of one piece, as places in ``a`` and in ``b``, and which of them close a group.

    Between two neighbouring ends lies one token of each side. A pair of equal ends
    belongs to the piece that holds the end in ``a``.
    """
    from_a, to_a, from_b, to_b = cut
    ends_a, ends_b = a[from_a:to_a], b[from_b:to_b]
    # Each end in a, and the token of b that holds it: maybe the first one of the next piece.
    over = from_b + np.searchsorted(ends_b, ends_a)
    closes = b[np.minimum(over, len(b) - 1)] == ends_a
    # Each end in b that is none in a: looked up in this piece and, at the cut, before it.
    under = from_a + np.searchsorted(ends_a, ends_b)
    alone = a[np.minimum(under, len(a) - 1)] != ends_b
    if from_a and len(ends_b) and a[from_a - 1] == ends_b[0]:
        alone[0] = False
    places_a = np.concatenate((np.arange(from_a, to_a), under[alone]))
    places_b = np.concatenate((over, np.arange(from_b, to_b)[alone]))
    order = np.argsort(np.concatenate((ends_a, ends_b[alone])), kind="stable")
    closes = np.concatenate((closes, np.zeros(int(alone.sum()), bool)))
    return places_a[order], places_b[order], closes[order]


def merge_ends(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pieces' overlaps, in order; ``a`` and ``b`` have the same last end."""
    cut_a, cut_b = cut_merge(a, b, step)
    for k in range(len(cut_a) - 1):
        yield merge_piece(a, b, (cut_a[k], cut_a[k + 1], cut_b[k], cut_b[k + 1]))


# Encoding -----------------------------------------------------------------------------


class Side:
    """Ids of all known stretches under one tokenizer, one after the other."""

    def __init__(self, sizes: list[int]):
        self.sizes = np.array(sizes, np.int64)
        self.clear()

    def clear(self) -> None:
        self.begins, self.counts, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def add(self, found: list[list[int]]) -> None:
        counts = np.fromiter(map(len, found), np.int64, len(found))
        begins = len(self.ids) + np.cumsum(counts) - counts
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        self.begins, self.counts = np.concatenate((self.begins, begins)), np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, ids))

    def joined(self, at: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches at the given places, and where each text's ids begin."""
        counts = self.counts[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.begins[at] - (ends - counts), counts)]
        return ids, np.concatenate(([0], ends))[edges]


class Stretches:
    """Both tokenizers' ids of distinct stretches."""

    def __init__(self, model_a: str, model_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(model_a)
        # Special strings inside a text are ordinary text.
        self.a.encode_special_tokens = True
        with open(model_a, encoding="utf-8") as file:
            told = json.load(file)
        if told["normalizer"] or told["pre_tokenizer"]["type"] != "ByteLevel" or not told["pre_tokenizer"]["use_regex"]:
            raise ValueError("the first vocabulary has to be a plain byte-level one")
        known = byte_chars()
        entries = sorted(told["model"]["vocab"].items(), key=lambda e: e[1])
        if [i for _, i in entries] != list(range(len(entries))) or any(c not in known for t, _ in entries for c in t):
            raise ValueError("the ids of the first vocabulary have gaps, or it has entries that are no bytes")

        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        normal = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        # White space that a piece may have after other characters does not part stretches.
        inner = {c for p in normal for c in re.findall(f"(?<=[^{MARK}{_WHITE}])[{MARK}{_WHITE}]", p)}
        if inner & {MARK, " "} or any("\n" in p for p in normal) or self.b.encode("x  y") == self.b.encode("x y"):
            raise ValueError("the second vocabulary joins words across white space")
        goes_on = f"(?:[{''.join(map(re.escape, sorted(inner)))}][{_WHITE}]*[^{_WHITE}]*)*" if inner else ""
        self.stretch = re.compile(f"[{_WHITE}]*[^{_WHITE}]+{goes_on}|[{_WHITE}]+")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        # What the library puts before a line end: taken off where a stretch has no space first.
        self.lead = len(self.b.encode("\n"))
        self.mark = [self.b.piece_to_id(MARK)]
        self.side_a = Side([len(t) for t, _ in entries])
        self.side_b = Side([len(p) for p in self.bytes_b])
        self.place: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.side_a.clear()
        self.side_b.clear()
        self.place.clear()
        self.odd: set[str] = set()
        self.chars = 0

    def add(self, stretches: list[str]) -> None:
        found_a = []
        for k in range(0, len(stretches), ASKED):  # the library tells much more of each than its ids
            found_a += [e.ids for e in self.a.encode_batch_fast(stretches[k : k + ASKED], add_special_tokens=False)]
        self.side_a.add(found_a)
        spaced = [s[0] == " " for s in stretches]
        asked = [s[1:] if m else "\n" + s for s, m in zip(stretches, spaced)]
        found = self.b.encode(asked, num_threads=1)
        ids_b = [(ids or self.mark) if m else ids[self.lead :] for m, ids in zip(spaced, found)]
        self.side_b.add(ids_b)
        told = b"".join(map(self.bytes_b.__getitem__, chain.from_iterable(ids_b)))
        if told != "".join(stretches).encode():
            self.odd.update(s for s, ids in zip(stretches, ids_b) if self._bytes(ids) != s.encode())
        self.place.update(zip(stretches, range(len(self.place), len(self.place) + len(stretches))))
        self.chars += sum(map(len, stretches))

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_b[i] for i in ids])

    def _is_whole(self, text: str, cut: list[str]) -> bool:
        """Whether the second tokenizer's bytes are those of the text."""
        if self.odd.isdisjoint(cut):
            return True
        at = np.array([self.place[s] for s in cut])
        ids, _ = self.side_b.joined(at, np.array([0, len(cut)]))
        return self._bytes(ids.tolist()) == text.encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, and where each text's ids begin; texts that do not come back have none."""
        if len(self.place) > TABLE_STRETCHES or self.chars > TABLE_CHARS:
            self.clear()
        marked = [" " + t if t else "" for t in texts]
        cut = [self.stretch.findall(t) for t in marked]
        self.add(list(dict.fromkeys(chain.from_iterable(cut)).keys() - self.place.keys()))
        if self.odd:
            cut = [parts if self._is_whole(t, parts) else [] for t, parts in zip(marked, cut)]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        edges = np.concatenate(([0], np.cumsum(counts)))
        return *self.side_a.joined(at, edges), *self.side_b.joined(at, edges)


# Operators ----------------------------------------------------------------------------

FIELDS = [
    StructField("a_ids", ArrayType(IntegerType(), False), False),
    StructField("b_ids", ArrayType(IntegerType(), False), False),
    StructField("a_ends", ArrayType(IntegerType(), False), False),
    StructField("b_ends", ArrayType(IntegerType(), False), False),
    StructField("n_overlaps", LongType(), False),
    StructField("groups", StringType(), False),
]


class Aligner:
    """Aligns texts with two tokenizers, a bounded run of them at a time."""

    def __init__(self, models: tuple[str, str]):
        self.table = Stretches(*models)
        size = max(len(self.table.side_a.sizes), len(self.table.side_b.sizes))
        # One list of strings: each id followed by a comma, by a bar and by a semicolon.
        self.numbers = pa.concat_arrays([_numbers(size, sep) for sep in ",|;"])

    def align(self, texts: pa.Array) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
        """Arrays of ``FIELDS``, and of all texts the linked pairs of ids and their number in each."""
        a, from_a, b, from_b = self.table.encode(strings(texts))
        ends_a, ends_b = np.cumsum(self.table.side_a.sizes[a]), np.cumsum(self.table.side_b.sizes[b])
        found = list(merge_ends(ends_a, ends_b)) if len(a) else []
        nothing = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
        place_a, place_b, closes = [np.concatenate(x) for x in zip(*found)] if found else nothing
        overlaps = np.diff(np.searchsorted(place_a, from_a))
        last_a, last_b = place_a[closes], place_b[closes]
        edges = np.searchsorted(last_a, from_a)
        first_a, first_b = np.repeat(from_a[:-1], np.diff(edges)), np.repeat(from_b[:-1], np.diff(edges))
        arrays = [
            lists(a, from_a, pa.int32()),
            lists(b, from_b, pa.int32()),
            lists(last_a + 1 - first_a, edges, pa.int32()),
            lists(last_b + 1 - first_b, edges, pa.int32()),
            pa.array(overlaps, pa.int64()),
            _spelled(self.numbers, (a, last_a), (b, last_b), from_a + from_b),
        ]
        return arrays, (a[last_a].astype(np.int64) << _HALF) | b[last_b], np.diff(edges)


def align(df: DataFrame, text: str = "text", models: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with the ids of both tokenizers and the groups into which shared ends cut them.

    ``a_ids`` and ``b_ids`` are the tokens of a space and the text; group k ends after
    ``a_ends[k]`` tokens of the one and ``b_ends[k]`` of the other; ``groups`` is the same
    as text (``a1,a2|b1;a3|b2``); ``n_overlaps`` counts the pairs of tokens that share bytes.

    A NULL or empty text, and one that the second tokenizer does not give back byte by
    byte, has no tokens. Very long texts are aligned whole, in pieces. Rows are neither
    joined nor moved, so repeated rows, NULL ids, an empty table and other columns stay
    as they are; columns of ``df`` with the new names are replaced.
    """
    paths = models or default_models()

    def start():
        aligner = Aligner(paths)
        return lambda texts: aligner.align(texts)[0]

    return add_columns(df, FIELDS, text, start, SLICE_BYTES)


def _numbers(size: int, sep: str) -> pa.Array:
    kind = pa.large_string()
    return pc.binary_join_element_wise(pa.array(np.arange(size)).cast(kind), pa.scalar(sep, kind), pa.scalar("", kind))


def _spelled(numbers: pa.Array, a: tuple, b: tuple, offsets: np.ndarray) -> pa.Array:
    """Groups as text: the ids of a group's first side, then those of its other side."""
    (ids_a, last_a), (ids_b, last_b) = a, b
    size = len(numbers) // 3
    group_a = np.searchsorted(last_a, np.arange(len(ids_a)))
    group_b = np.searchsorted(last_b, np.arange(len(ids_b)))
    taken = np.empty(len(ids_a) + len(ids_b), np.int64)
    before = np.concatenate(([0], last_b + 1))
    at_a = np.arange(len(ids_a)) + before[group_a]
    at_b = np.arange(len(ids_b)) + (last_a + 1)[group_b] if len(last_a) else np.empty(0, np.int64)
    taken[at_a] = ids_a
    taken[at_a[last_a]] += size
    taken[at_b] = ids_b
    taken[at_b[last_b]] += 2 * size
    whole = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), numbers.take(pa.array(taken))), pa.scalar("", pa.large_string()))
    return pc.utf8_rtrim(whole, ";").cast(pa.string())


#: From the arrays of ``FIELDS``, those of further columns.
Summary = Callable[[dict[str, pa.Array]], list[pa.Array]]


def score_links(
    df: DataFrame,
    text: str = "text",
    models: tuple[str, str] | None = None,
    fields: Sequence[StructField] = (),
    summary: Summary | None = None,
) -> DataFrame:
    """How common the links of each text are: ``n_links``, ``n_best`` and ``count_sum``.

    A link is a pair of tokens, one of each tokenizer, that end together: the last ones
    of a group of ``align``. The count of a pair of ids is the number of its links in all
    rows; a link is best where its pair has the highest count of all pairs with the same
    second id (ties included), and ``count_sum`` adds the counts of a row's links. The
    other columns of ``df`` are kept, without the text; ``summary`` gives the columns
    ``fields`` from what ``align`` knows of the rows, in the same task, so that the
    tokens themselves are neither written nor shuffled.

    A text without tokens has zeros. Each row is counted as it comes, so repeated rows
    count repeatedly; an empty table gives an empty one; columns of ``df`` with the names
    of the results are replaced.

    Rows are written in parts that hold their distinct pairs once, so the counts are
    summed, and come back, over the distinct pairs of parts, not over links. Nothing is
    broadcast but the highest count of each second id, as many rows as its vocabulary.
    """
    results = ("n_links", "n_best", "count_sum")
    made = [f.name for f in fields]
    kept = [c for c in df.columns if c not in (*results, *made, text)]
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    known = rows.schema["row"].dataType
    paths = models or default_models()
    folder = fresh_path(spark, "stage-links")
    packed = StructType(
        [
            StructField("part", LongType(), False),
            StructField("row", StructType([*known, *fields])),
            StructField("gaps", ArrayType(IntegerType(), False)),
            StructField("times", ArrayType(IntegerType(), False)),
            StructField("codes", ArrayType(LongType(), False)),
        ]
    )
    rows.mapInArrow(_packer(paths, known.names, made, summary), packed).write.parquet(folder)

    def staged() -> DataFrame:
        return spark.read.schema(packed).parquet(folder)

    # Part rows have codes and times, document rows gaps and times.
    pairs = staged().filter("codes IS NOT NULL").select("part", F.explode(F.arrays_zip("codes", "times")).alias("p"))
    pairs = pairs.select("part", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    counts = pairs.groupBy("code").agg(F.sum(F.col("times").cast("long")).alias("count"))
    second = F.col("code").bitwiseAND(_LOW)
    highest = counts.groupBy(second.alias("b")).agg(F.max("count").alias("highest"))
    ranked = counts.join(F.broadcast(highest), second == F.col("b"))
    ranked = ranked.select("code", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = pairs.join(ranked, "code").select("part", "code", "count", "best")

    docs = staged().filter("codes IS NULL").select("part", "row", "gaps", "times")
    out = StructType([docs.schema["row"], *[StructField(name, LongType(), False) for name in results]])
    scored = docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_score, out)
    return scored.select(*[F.col("row").getField(c).alias(c) for c in (*kept, *made)], *results)


#: A pair of ids as one number: the second id in the lower half.
_HALF = 32
_LOW = (1 << _HALF) - 1


def _packer(models: tuple[str, str], kept: list[str], made: list[str], summary: Summary | None):
    """Rows in parts; a row holds its distinct pairs as places in the sorted pairs of its part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, aligner = TaskContext.get(), None
        part = (context.partitionId() if context else 0) << 32
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        links = 0
        for batch in batches:
            aligner = aligner or Aligner(models)
            for piece in slices(batch, 1, SLICE_BYTES):
                arrays, codes, counts = aligner.align(piece.column(1))
                more = summary(dict(zip([f.name for f in FIELDS], arrays))) if summary else []
                row = piece.column(0)
                row = pa.StructArray.from_arrays([*row.flatten(), *more], names=[*kept, *made])
                held.append((row, counts, codes))
                links += len(codes)
                if links >= PART_LINKS:
                    yield from _part(part, held)
                    part, held, links = part + 1, [], 0
        if held:
            yield from _part(part, held)

    return freeing(pack)


def _part(part: int, held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    codes = np.concatenate([codes for _, _, codes in held])
    distinct, at, times = np.unique(codes, return_inverse=True, return_counts=True)
    names = ["part", "row", "gaps", "times", "codes"]
    nothing = [pa.nulls(1, held[0][0].type), pa.nulls(1, pa.list_(pa.int32()))]
    own = [pa.array([times], pa.list_(pa.int32())), pa.array([distinct], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *nothing, *own], names=names)
    low = 0
    for rows, counts, _ in held:
        size = int(counts.sum())
        # Distinct places of each row, in order, as gaps: small numbers, which compress well.
        key = np.repeat(np.arange(len(counts)), counts) * np.int64(len(distinct) + 1) + at[low : low + size]
        keys, times = np.unique(key, return_counts=True)
        owner, place = np.divmod(keys, len(distinct) + 1)
        edges = np.searchsorted(owner, np.arange(len(counts) + 1))
        gaps = np.diff(place, prepend=0)
        starts = edges[:-1][np.diff(edges) > 0]
        gaps[starts] = place[starts]
        columns = [pa.array(np.full(len(counts), part)), rows, lists(gaps, edges, pa.int32()), lists(times, edges, pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(counts), pa.list_(pa.int64()))], names=names)
        low += size


def _score(rows: pa.Table, answers: pa.Table) -> pa.Table:
    answers = answers.sort_by("code")
    count, best = answers.column("count").to_numpy(), answers.column("best").to_numpy().astype(np.int64)
    gaps, times = rows.column("gaps").combine_chunks(), rows.column("times").combine_chunks()
    sizes = np.asarray(pc.list_value_length(gaps), dtype=np.int64)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    gap, times = np.asarray(gaps.flatten(), dtype=np.int64), np.asarray(times.flatten(), dtype=np.int64)
    # Running sums of gaps, started anew in each row.
    running = np.concatenate(([0], np.cumsum(gap)))
    place = running[1:] - np.repeat(running[edges[:-1]], sizes)

    def total(values: np.ndarray) -> pa.Array:
        sums = np.concatenate(([0], np.cumsum(values)))[edges]
        return pa.array(np.diff(sums), pa.int64())

    columns = [total(times), total(times * best[place]), total(times * count[place])]
    return pa.table([rows.column("row"), *columns], names=["row", "n_links", "n_best", "count_sum"])
