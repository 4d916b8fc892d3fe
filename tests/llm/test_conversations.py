import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.support import folder, given, rows
from wardflow.llm import conversations
from wardflow.llm.queries import QUERIES, damage

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
STATES = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
NAMES = {"u": "user", "a": "assistant"}


def fault_of(role, text, earlier):
    core = text.rstrip(WHITE)
    if not core.strip(WHITE):
        return "blank"
    if (role, text) in earlier:
        return "duplicate"
    return None if core[-1] in ".!?" else "truncated"


def cheapest(turns):
    """Least (cost, audit) and the repaired turns, by comparing whole audits in every state.

    ``turns`` are (role, text, fault). The state is the last initial.
    """
    worst = (10**9, "")

    def inserted(best):
        for _ in range(6):
            for q, nexts in STATES.items():
                for c in nexts:
                    if c != "s" and best[c][0] < 10**9:
                        cost, audit, kept = best[c]
                        best[q] = min(best[q], (cost + 3, "I" + audit, ((NAMES[c], ""), *kept)))
        return best

    best = inserted({q: (0, "", ()) if q in ("", "a") else (*worst, ()) for q in STATES})
    for role, text, fault in reversed(turns):
        now = {}
        for q, nexts in STATES.items():
            cost, audit, kept = best[q]
            ways = [(cost + 4, "D" + audit, kept)]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for c in nexts:
                    cost, audit, kept = best[c]
                    if role[:1] == c:
                        ways.append((cost + extra, "K" + audit, ((role, text), *kept)))
                    if c != "s":
                        ways.append((cost + 3 + extra, "R" + audit, ((NAMES[c], text), *kept)))
            now[q] = min(ways)
        best = inserted(now)
    return best[""]


def plainly(data):
    """What the registered query has to give, from (conv_id, turn, role, text) rows."""
    told = defaultdict(list)
    for conv, turn, role, text in data:
        rest = told[conv]
        conv, at, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        kind = zlib.crc32(f"{conv}:{at}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        rest += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, rest in told.items():
        rest.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        earlier, turns = set(), []
        for _, role, text in rest:
            turns.append((role, text, fault_of(role, text, earlier)))
            earlier.add((role, text))
        cost, audit, kept = cheapest(turns)
        numbers = [t for t, _, _ in rest if t is not None]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
        yield conv, {
            "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            **{f: sum(x == f for _, _, x in turns) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        }


def check(spark, data, partitions=3):
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    got = {r.pop("conv_id"): r for r in rows(QUERIES["op13_conversations"](spark, folder(spark, conversations=df)))}
    assert got == dict(plainly(data))
    return got


def made(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "u"]
    texts = ["Yes.", "No!", "and then", " \n", "", None, "What? ", "Well.\n", "é…", "Ok\x1c", "a.b"]
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}."
            yield conv if conv else None, None if rng.random() < 0.05 else turn + (turn > 3), rng.choice(roles), text


def test_query_on_the_given_table(spark):
    data = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in given("conversations", "sf0.01")]
    check(spark, data)


def test_query_on_odd_rows_and_ties(spark):
    data = list(made(4, 120, 9))
    got = check(spark, data + data[::7], 5)
    assert {c for r in got.values() for c in r["audit"]} == set("DIKR")
    lost = [(k, 0, "user", "Hi.") for k in range(60)]
    got = check(spark, lost)
    empty = [r for r in got.values() if not r["audit"]]
    assert empty and all(r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() and r["cost"] == 0 for r in empty)


def test_one_conversation_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(9)
        long = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["x.", f"{t} a", f"{t}!"])) for t in range(900)]
        same = [(8, 1, "user", "again.")] * 700
        check(spark, long + same + list(made(5, 20, 5)), 6)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_tables_of_blocks_equal_a_comparison_of_audits():
    table, rng = conversations.Table(), random.Random(2)
    kinds = [(r, f) for r in ("s", "u", "a", "x") for f in (None, "truncated")] + [("u", "blank")]
    for _ in range(1500):
        turns = [(r, "", f) for r, f in (rng.choice(kinds) for _ in range(rng.randint(0, 13)))]
        symbols = np.array([conversations.GONE if f == "blank" else conversations.symbol_of(r, f is not None) for r, _, f in turns], np.int64)
        cost, audit, _ = cheapest(turns)
        assert table.cost(symbols) == cost
        assert "".join(e[::2] for e in table.trace(symbols, 0, 0, True)) == audit
        # The same from pieces, each a map of vectors and states.
        cuts = sorted(rng.randint(0, len(symbols)) for _ in range(3))
        pieces = [p for p in np.split(symbols, cuts) if len(p)]
        maps, after, vector, state, found = [table.whole(p) for p in pieces], [], 0, 0, ""
        for before, _ in reversed(maps):
            after.insert(0, vector)
            vector = int(before[vector])
        for k, (piece, (_, states)) in enumerate(zip(pieces, maps)):
            found += "".join(e[::2] for e in table.trace(piece, after[k], state, k == len(pieces) - 1))
            state = int(states[after[k], state])
        assert found == audit or not pieces


def test_edits_are_rows(spark):
    data = [(1, 0, "user", "Hi."), (1, 1, "user", "More"), (1, 3, "assistant", "Hm."), (1, 4, "assistant", "Hm.")]
    df = spark.createDataFrame(data, SCHEMA).withColumn("edit", F.lit("x")).withColumn("place", F.lit(1))
    got = sorted(rows(conversations.repair(df)), key=lambda r: (r["place"], r["step"]))
    assert [(r["edit"], r["role"], r["text"], r["fault"], r["turn"], r["cost"]) for r in got] == [
        ("K", "user", "Hi.", None, 0, 0),
        ("D", None, None, "truncated", 1, 4),
        ("K", "assistant", "Hm.", None, 3, 0),
        ("D", None, None, "duplicate", 4, 4),
    ]


@pytest.mark.parametrize("frame", ["damaged", "empty"])
def test_damage_and_empty_tables(spark, frame):
    empty = spark.createDataFrame([], SCHEMA)
    if frame == "empty":
        assert rows(QUERIES["op13_conversations"](spark, folder(spark, conversations=empty))) == []
    assert rows(conversations.report(conversations.repair(damage(empty)))) == []
