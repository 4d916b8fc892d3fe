"""Repair of conversations: the cheapest edits that make their turns alternate.

Roles count by their first letter; a repaired conversation reads ``(s?(ua)+)?``. What is
still to pay after a turn depends on the state of that pattern alone, so it is a vector
of four costs, and, less its smallest entry, one of a few dozen such vectors. A turn maps
vectors to vectors. As in the method of the Four Russians, the maps of all blocks of
``BLOCK`` turns are computed once; a conversation is then read block by block, from its
end, with one lookup each. The blocks are expanded the other way round, from the
conversation's start: there each step takes the ASCII-least of the edits that are still
cheapest, so ties are decided as by comparing whole audits.

A conversation of any length is spread over tasks: the piece of it in one range of rows is
again a map of vectors (and of states), and only these maps are gathered, one or two for
each range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wardflow.llm.batches import ship
from wardflow.session import fresh_path

BLOCK = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: nothing yet, after s, after u, after a. All but the third and second may end.
STATES = 4
#: The state after an inserted or changed turn, and that turn's role.
NEXT = (2, 2, 3, 2)
ROLES = ("user", "user", "assistant", "user")
#: The state after a kept turn, by its initial; None where it may not stand.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "": (None,) * 4}

# Symbols: no turn (it fills the last block), a turn to delete, then initials, whole and truncated.
NOTHING, GONE = 0, 1
INITIALS = tuple(KEPT)
SYMBOLS = 2 + 2 * len(INITIALS)


def symbol_of(initial: str, truncated: bool) -> int:
    return 2 + 2 * INITIALS.index(initial if initial in KEPT else "") + truncated


def _told(symbol: int) -> tuple[str, int]:
    """Initial of a turn and what keeping it costs."""
    return INITIALS[(symbol - 2) // 2], TRUNCATED * (symbol % 2)


def _closed(costs: list[int]) -> list[int]:
    for _ in range(STATES):
        costs = [min(costs[q], INSERT + costs[NEXT[q]]) for q in range(STATES)]
    return costs


def _before(symbol: int, after: tuple[int, ...]) -> list[int]:
    """What is to pay before a turn, by state, given what is to pay after it."""
    if symbol == NOTHING:
        return list(after)
    costs = [DELETE + after[q] for q in range(STATES)]
    if symbol != GONE:
        initial, extra = _told(symbol)
        for q in range(STATES):
            costs[q] = min(costs[q], REROLE + extra + after[NEXT[q]])
            if KEPT[initial][q] is not None:
                costs[q] = min(costs[q], KEEP + extra + after[KEPT[initial][q]])
    return _closed(costs)


class Table:
    """Maps of normalised cost vectors, for each turn and for each block of turns."""

    def __init__(self):
        end = tuple(_closed([0, 99, 99, 0]))
        self.vectors, known = [end], {end: 0}
        steps: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows while it is read
            steps.append([])
            for symbol in range(SYMBOLS):
                costs = _before(symbol, vector)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in known:
                    known[normal] = len(self.vectors)
                    self.vectors.append(normal)
                steps[-1].append((known[normal], least))
        count = len(self.vectors)
        self.step = np.array([[to for to, _ in row] for row in steps], np.int64)
        paid = np.array([[least for _, least in row] for row in steps], np.int64)
        states = np.array([[[self._walk(s, v, q)[1] for q in range(STATES)] for s in range(SYMBOLS)] for v in range(count)])
        # Blocks, by one more turn in front each time: to, paid and states by vector and code.
        self.to, self.paid, self.states = self.step, paid, states
        for _ in range(BLOCK - 1):
            front, rest = np.divmod(np.arange(SYMBOLS * self.to.shape[1]), self.to.shape[1])
            inner = self.to[:, rest]
            rows = np.arange(count)[:, None, None]
            self.states = self.states[rows, rest[None, :, None], states[inner, front]]
            self.paid = self.paid[:, rest] + paid[inner, front]
            self.to = self.step[inner, front]
        self.opened: dict[tuple[int, int, int], tuple[tuple[str, ...], int]] = {}

    def _walk(self, symbol: int, vector: int, state: int) -> tuple[str, int]:
        """Edits at one turn, as letters with the role's initial, and the state after it.

        ``vector`` is what is to pay after the turn.
        """
        after = self.vectors[vector]
        if symbol == NOTHING:
            return "", state
        before, edits = _before(symbol, after), ""
        while True:
            if DELETE + after[state] == before[state]:
                return edits + "D-", state
            if INSERT + before[NEXT[state]] == before[state]:
                edits += "I" + ROLES[state][0]
                state = NEXT[state]
                continue
            initial, extra = _told(symbol)
            kept = KEPT[initial][state]
            if kept is not None and KEEP + extra + after[kept] == before[state]:
                return edits + "K" + initial, kept
            return edits + "R" + ROLES[state][0], NEXT[state]

    def codes(self, symbols: np.ndarray) -> list[int]:
        """The blocks' numbers; the last block is filled up."""
        filled = np.zeros(-(-len(symbols) // BLOCK) * BLOCK, np.int64)
        filled[: len(symbols)] = symbols
        return (filled.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()

    def cost(self, symbols: np.ndarray) -> int:
        total, vector = 0, 0
        for code in reversed(self.codes(symbols)):
            total += int(self.paid[vector, code])
            vector = int(self.to[vector, code])
        return total + self.vectors[vector][0]

    def _open(self, code: int, vector: int, state: int) -> tuple[tuple[str, ...], int]:
        """Edits at each turn of a block, expanded once for each way it is met."""
        key = code, vector, state
        if key not in self.opened:
            turns = [code // SYMBOLS**k % SYMBOLS for k in range(BLOCK - 1, -1, -1)]
            inside = [vector]
            for symbol in reversed(turns[1:]):
                inside.append(int(self.step[inside[-1], symbol]))
            edits = []
            for symbol, after in zip(turns, reversed(inside)):
                found, state = self._walk(symbol, after, state)
                edits.append(found)
            self.opened[key] = tuple(edits), state
        return self.opened[key]

    def trace(self, symbols: np.ndarray, vector: int, state: int, ends: bool) -> list[str]:
        """Edits at each turn of a piece that begins in ``state``, with ``vector`` to pay after it.

        Where the conversation ends here, what is inserted at its end follows as one more item.
        """
        codes = self.codes(symbols)
        after = []
        for code in reversed(codes):
            after.append(vector)
            vector = int(self.to[vector, code])
        edits: list[str] = []
        for code, vector in zip(codes, reversed(after)):
            found, state = self._open(code, vector, state)
            edits += found
        del edits[len(symbols) :]
        if ends:
            last = ""
            while state in (1, 2):
                last += "I" + ROLES[state][0]
                state = NEXT[state]
            edits.append(last)
        return edits

    def whole(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A piece as one map: the vector before it, and the state after it by state before it, for each vector after it."""
        vector = np.arange(len(self.vectors))
        states = np.broadcast_to(np.arange(STATES), (len(vector), STATES))
        every = np.arange(len(vector))[:, None]
        for code in reversed(self.codes(symbols)):
            states = states[every, self.states[vector, code]]
            vector = self.to[vector, code]
        return vector, states


@cache
def table() -> Table:
    return Table()


# Over ranges of rows ------------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"
_PIECE = StructType(
    [
        StructField("part", LongType(), False),
        StructField("edge", IntegerType(), False),
        StructField("vectors", ArrayType(IntegerType()), False),
        StructField("states", ArrayType(IntegerType()), False),
    ]
)
_PLAN = StructType(
    [
        StructField("part", LongType(), False),
        StructField("edge", IntegerType(), False),
        StructField("vector", IntegerType(), False),
        StructField("state", IntegerType(), False),
        StructField("ends", IntegerType(), False),
    ]
)


def repair(df: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation of ``df`` (conv_id, turn, role, text), one row each.

    Rows of a conversation are taken by turn, NULL first; rows of one turn by role and
    text. A NULL conv_id is a conversation of its own; a NULL role or text counts as one space.
    ``fault`` is the row's first one: blank, duplicate (role and text stood earlier) or
    truncated. ``edit`` is K (kept), R (other role), D (deleted) or I (inserted, with an empty
    text and no turn); ``role`` and ``text`` are the repaired ones (NULL where deleted),
    ``role_was`` the role before, ``cost`` what the edit costs; ``place`` and ``step`` give
    their order. Repeated rows are duplicates; an empty table has no edits; other columns
    are left out, whatever their names. An empty role, or one with another first letter
    than s, u or a, can not be kept.

    Texts are written once and joined again to their edits; rows are ordered, and the pieces
    of long conversations put together, without them.
    """
    spark = df.sparkSession
    ship(spark)
    space = F.lit(" ")
    given = df.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role_was"), F.coalesce("text", space).alias("text"), F.monotonically_increasing_id().alias("rid")
    )
    given = _staged(given, "stage-turns")

    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    keys = given.select(
        "conv_id",
        "turn",
        "role_was",
        F.left("text", F.lit(64)).alias("begins"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
        "rid",
        (core == "").alias("blank"),
        (~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    # A row's number is the last key, so that equal rows, however many, part into ranges too.
    order = ["conv_id", "turn", "role_was", "begins", "digest", "rid"]
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    ordered = _staged(ordered.select("conv_id", "turn", "role_was", "digest", "rid", "blank", "cut", place.alias("place")), "stage-order")

    first = ordered.filter("NOT blank").groupBy("conv_id", "role_was", "digest").agg(F.min("place").alias("place"))
    first = first.select("place", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(F.col("cut"), "truncated")
    )
    letter = F.left("role_was", F.lit(1))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(
        F.coalesce(*[F.when(letter == c, symbol_of(c, False)) for c in INITIALS if c], F.lit(symbol_of("", False)))
        + F.when(F.col("fault") == "truncated", 1).otherwise(0)
    )
    marked = ordered.join(first, "place", "left").withColumn("fault", fault)
    marked = marked.select(
        F.shiftright("place", 33).alias("part"), "place", "conv_id", "rid", "turn", "role_was", "fault", symbol.cast("int").alias("symbol")
    )
    marked = _staged(marked, "stage-marks")

    conv = marked.schema["conv_id"]
    pieces = marked.select("part", "place", "conv_id", "symbol").groupBy("part").applyInArrow(_pieces, StructType([*_PIECE, conv]))
    plan = pieces.groupBy("conv_id").applyInArrow(_plan, _PLAN)
    fields = ["conv_id", "place", "step", "rid", "turn", "role_was", "fault", "edit", "role", "cost"]
    added = [StructField("step", IntegerType()), StructField("edit", StringType()), StructField("role", StringType()), StructField("cost", LongType())]
    kinds = {f.name: f for f in [*marked.schema, *added]}
    edits = marked.groupBy("part").cogroup(plan.groupBy("part")).applyInArrow(_edits, StructType([kinds[c] for c in fields]))
    edits = _staged(edits, "stage-edits")

    stays = F.col("edit").isin("K", "R")
    texts = edits.filter(stays).join(given.select("rid", "text"), "rid")
    rest = edits.filter(~stays).withColumn("text", F.when(F.col("edit") == "I", ""))
    columns = ["conv_id", "place", "step", "turn", "role_was", "fault", "edit", "role", "text", "cost"]
    return texts.select(columns).unionByName(rest.select(columns))


def _staged(df: DataFrame, label: str) -> DataFrame:
    folder = fresh_path(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _runs(rows: pa.Table) -> np.ndarray:
    """Where the conversations of sorted rows begin, and the end of the last."""
    ids = rows.column("conv_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.concatenate(([0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]))


def _pieces(rows: pa.Table) -> pa.Table:
    """The first and the last conversation of a range: they may go on in its neighbours."""
    rows = rows.sort_by("place")
    runs, symbols = _runs(rows), rows.column("symbol").to_numpy()
    edges = sorted({0, len(runs) - 2})
    maps = [table().whole(symbols[runs[k] : runs[k + 1]]) for k in edges]
    part = rows.column("part")[0].as_py()
    columns = [
        pa.array([part] * len(edges), pa.int64()),
        pa.array([int(k > 0) for k in edges], pa.int32()),
        pa.array([v.tolist() for v, _ in maps], pa.list_(pa.int32())),
        pa.array([s.ravel().tolist() for _, s in maps], pa.list_(pa.int32())),
        rows.column("conv_id").take(pa.array([runs[k] for k in edges])),
    ]
    return pa.table(columns, names=[*_PIECE.names, "conv_id"])


def _plan(pieces: pa.Table) -> pa.Table:
    """For each piece of one conversation: what is to pay after it, and the state it begins in."""
    found = sorted(pieces.select(_PIECE.names).to_pylist(), key=lambda p: (p["part"], p["edge"]))
    vector = 0
    for k, piece in enumerate(reversed(found)):
        piece["vector"], piece["ends"] = vector, int(k == 0)
        vector = piece["vectors"][vector]
    state = 0
    for piece in found:
        piece["state"] = state
        state = piece["states"][piece["vector"] * STATES + state]
    kinds = {"part": pa.int64()}
    return pa.table([pa.array([p[c] for p in found], kinds.get(c, pa.int32())) for c in _PLAN.names], names=_PLAN.names)


_SPELLED = {role[0]: role for role in ROLES}
_COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def _edits(rows: pa.Table, plan: pa.Table) -> pa.Table:
    rows = rows.sort_by("place")
    runs, symbols = _runs(rows), rows.column("symbol").to_numpy()
    edge = {p["edge"]: (p["vector"], p["state"], bool(p["ends"])) for p in plan.to_pylist()}
    last = len(runs) - 2
    # Of each edit: its row, or the one beside it; its order there; letter and role.
    near, steps, own, letters, roles = [], [], [], [], []
    for k in range(last + 1):
        vector, state, ends = edge[0] if k == 0 else edge[1] if k == last else (0, 0, True)
        found = table().trace(symbols[runs[k] : runs[k + 1]], vector, state, ends)
        for turn, edits in enumerate(found):
            row = runs[k] + min(turn, runs[k + 1] - runs[k] - 1)
            # What is inserted at the end comes after the last row's own edits.
            step = 0 if turn < runs[k + 1] - runs[k] else 2 * STATES
            for at in range(0, len(edits), 2):
                near.append(row)
                steps.append(step + at // 2)
                own.append(edits[at] != "I")
                letters.append(edits[at])
                roles.append(edits[at + 1])
    near, own = pa.array(near, pa.int64()), np.array(own, bool)
    of_row = pc.if_else(pa.array(own), near, pa.nulls(len(own), pa.int64()))
    was, fault = rows.column("role_was").take(of_row), rows.column("fault").take(of_row)
    new = [None if e == "D" else _SPELLED[r] if e != "K" else w for e, r, w in zip(letters, roles, was.to_pylist())]
    cost = [_COSTS[e] + TRUNCATED * (f == "truncated" and e != "D") for e, f in zip(letters, fault.to_pylist())]
    columns = {
        "conv_id": rows.column("conv_id").take(near),
        "place": rows.column("place").take(near),
        "step": pa.array(steps, pa.int32()),
        "rid": rows.column("rid").take(of_row),
        "turn": rows.column("turn").take(of_row),
        "role_was": was,
        "fault": fault,
        "edit": pa.array(letters, pa.string()),
        "role": pa.array(new, pa.string()),
        "cost": pa.array(cost, pa.int64()),
    }
    return pa.table(columns)


# Reports ------------------------------------------------------------------------------

_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def report(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``: faults, cost, edits and a digest of the result.

    ``gaps`` counts the turn numbers missing between the least and the greatest one;
    ``illegal`` the neighbours whose roles may not follow each other. A conversation's
    rows are read in order by one task, one at a time: its digest is of one long string.
    """
    ship(edits.sparkSession)
    schema = StructType(
        [
            StructField("conv_id", edits.schema["conv_id"].dataType),
            *[StructField(name, LongType(), False) for name in _REPORT],
            StructField("audit", StringType(), False),
            StructField("repaired_sha256", StringType(), False),
        ]
    )
    columns = ["conv_id", "turn", "role_was", "fault", "edit", "role", "text", "cost"]
    ordered = edits.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    return ordered.select(columns).mapInArrow(_reports, schema)


class _Sums:
    """What is known of the conversation that is being read."""

    def __init__(self, conv):
        self.conv, self.faults = conv, dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.distinct = 0
        self.least = self.turn = self.initial = None
        self.audit: list[str] = []
        self.digest, self.begun = hashlib.sha256(), False

    def add(self, turn, was, fault, edit, role, text, cost) -> None:
        self.cost += cost
        self.audit.append(edit)
        if fault:
            self.faults[fault] += 1
        if edit != "I":
            if self.initial is not None and self.initial + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = was[:1]
            if turn is not None and turn != self.turn:
                self.distinct += 1
                self.least, self.turn = turn if self.least is None else self.least, turn
        if edit != "D":
            self.digest.update(f"{chr(10) * self.begun}{role}:{text}".encode())
            self.begun = True

    def row(self) -> list:
        gaps = 0 if self.turn is None else self.turn - self.least + 1 - self.distinct
        return [self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()]


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = kind = None

    def given(rows: list[list]) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * len(_REPORT), pa.string(), pa.string()]
        names = ["conv_id", *_REPORT, "audit", "repaired_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, *values in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held.conv != conv:
                if held is not None:
                    done.append(held.row())
                held = _Sums(conv)
            held.add(*values)
        if done:
            yield given(done)
    if held is not None:
        yield given([held.row()])
