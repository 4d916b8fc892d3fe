import random
import re

import numpy as np
import pyarrow as pa

from tests.llm.support import documents, folder, given, rows
from tests.llm.test_licenses import lower
from wardflow.llm import parity_join
from wardflow.llm.components import components
from wardflow.llm.queries import QUERIES


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(texts, ids):
    """All pairs with a shingle in common, counted one by one; components by union-find."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        counts = {}
        for x in s:
            for j in where.setdefault(x, []):
                counts[j] = counts.get(j, 0) + 1
            where[x].append(i)
        for j, both in counts.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(texts)):
        r = root(i)
        least[r] = ids[i] if least.get(r) is None else least[r] if ids[i] is None else min(least[r], ids[i])
    return [(len(s), least[root(i)]) for i, s in enumerate(sets)]


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    place = folder(spark, documents=documents(spark, texts, ids, extra="1 AS component_id"))
    got = rows(QUERIES["op2_parity_join"](spark, place))
    wanted = brute(texts, ids)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == sorted(
        (str(i), n, str(c)) for i, (n, c) in zip(ids, wanted)
    )


def test_sets_match_plain_ones():
    texts = [None, "", " \t", "a", "A b", "a b c d e", "a b c d e f a b c d e", "É é\x0bx", "w " * 5000, " lead trail "]
    tokens, first = parity_join.shingle_sets(pa.array(texts, pa.string()))
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
    names = parity_join.set_ids(tokens, first)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (names[i] == names[j]) == (shingles(a) == shingles(b))


def test_sketch_distance_never_exceeds_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 62, size, dtype=np.uint64)
        b = np.concatenate((a[: int(size * rng.uniform(0.7, 1))], rng.integers(0, 1 << 62, int(size * rng.uniform(0, 0.3)), dtype=np.uint64)))
        both, first = np.concatenate((np.sort(a), np.sort(b))), np.array([0, len(a), len(a) + len(b)])
        one, two = parity_join.sketches(both, first)
        same = len(np.intersect1d(a, b))
        if 100 * same >= 75 * (len(a) + len(b) - same):
            assert parity_join.may_be_similar(len(a), one, len(b), two)


def test_pairs_at_the_threshold_share_a_block():
    """Sizes of all bands, sets just similar: equal sizes, subsets, and in between."""
    rng = np.random.default_rng(9)
    for size in [3, 4, 5, 6, 7, 8, 11, 12, 17, 18, 26, 27, 40, 41, 90, 137, 138, 400, 2000]:
        for _ in range(30):
            union = rng.choice(1 << 62, size + 200, replace=False).astype(np.uint64)[:size]
            lost = size - int(np.ceil(0.75 * size))
            cut = int(rng.integers(0, lost + 1))
            a, b = union[: size - cut], union[lost - cut :]
            both, first = np.concatenate((np.sort(a), np.sort(b))), np.array([0, len(a), len(a) + len(b)])
            if min(len(a), len(b)) <= parity_join.ALONE:
                continue
            keys, edges = parity_join.block_keys(both, first)
            assert set(keys[: edges[1]]) & set(keys[edges[1] :]), (size, cut)


def some_sets(rng, count):
    """Sets of which many are alike, as sorted hashes and where each begins."""
    base = rng.choice(1 << 62, 90, replace=False).astype(np.uint64)
    own = [rng.choice(1 << 62, int(rng.integers(0, 60)), replace=False).astype(np.uint64) for _ in range(count)]
    sets = [np.unique(np.concatenate((base[: int(rng.integers(3, 91))], o))) for o in own]
    return sets, np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets])))


def similar(a, b):
    both = len(np.intersect1d(a, b))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def test_similar_sets_share_one_of_their_first_shingles():
    rng = np.random.default_rng(3)
    sets, tokens, first = some_sets(rng, 80)
    found, counts = np.unique(tokens, return_counts=True)
    for frequent, known in ((found[:0], counts[:0]), (found[counts > 3], counts[counts > 3])):
        keys, edges = parity_join.prefixes(tokens, first, frequent, known)
        heads = [set(keys[a:b]) for a, b in zip(edges, edges[1:])]
        assert [len(h) for h in heads] == [len(x) // 4 + 1 for x in sets]
        assert all(heads[i] & heads[j] for i in range(80) for j in range(i) if similar(sets[i], sets[j]))


def test_sketches_compared_as_arrays_give_what_single_pairs_give(monkeypatch):
    sets, tokens, first = some_sets(np.random.default_rng(4), 60)
    members = list(zip([len(x) for x in sets], parity_join.sketches(tokens, first)))
    monkeypatch.setattr(parity_join, "FEW_PAIRS", 0)
    arrays = {(i, j): r for i, j, r in parity_join._all_ratios(members[:25], members[25:])}
    monkeypatch.setattr(parity_join, "FEW_PAIRS", 10**6)
    single = {(i, j): r for i, j, r in parity_join._all_ratios(members[:25], members[25:])}
    assert arrays.keys() == single.keys() and arrays
    assert all(np.isclose(arrays[pair], single[pair]) for pair in single)
    assert all((i, j) in single for i in range(25) for j in range(35) if similar(sets[i], sets[25 + j]))


def test_rows_compared_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """A passage in many texts, and near copies alike only through some others: buckets far beyond a cell."""
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    monkeypatch.setattr(parity_join, "CELL", 16)
    monkeypatch.setattr(parity_join, "CROWD", 8)
    dealt, cells = [], parity_join._cells

    def counted(*given):
        dealt.append((out := cells(*given)).count())
        return out

    monkeypatch.setattr(parity_join, "_cells", counted)
    passage, base = text(40), text(120)
    texts = [f"{passage} {text(rng.randint(16, 40))}" for _ in range(600)]
    texts += [near(base, 0.03, rng) for _ in range(150)]
    check(spark, texts[:300] + texts[600:675])
    check(spark, texts)
    assert dealt[0] and dealt[1] <= 3 * dealt[0], dealt


def near(text, share, rng):
    words = text.split()
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words)


def test_groups_copies_and_passages(spark):
    """Copies, near copies of one text that are not alike among themselves, chains, shared passages."""
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    base, passage, small = text(160), text(60), text(9)
    texts = [base] + [near(base, 0.018, rng) for _ in range(400)] + [near(base, 0.04, rng) for _ in range(100)]
    texts += [f"{passage} {text(rng.randint(5, 120))}" for _ in range(500)]
    texts += [base.upper()] * 60 + [small, small + " x", "y " + small, small + " x y", "a b", "A  B", "a b c", "a", "a"]
    chain = text(200).split()
    texts += [" ".join(chain[i : i + 150]) for i in range(0, 50, 5)]
    texts += [None, "", " ", None, text(30_000)]
    check(spark, texts)


def test_given_documents(spark):
    check(spark, [d["text"] for d in given("documents", "sf0.01")])


def test_repeated_and_null_ids_and_empty_table(spark):
    texts = ["one two three four five six", "One two three four five six", "other words here", None, "", "other words here", "z"]
    check(spark, texts, [5, 5, None, None, 7, None, None])
    assert parity_join.near_duplicates(documents(spark, ["a"]).limit(0)).count() == 0


def test_keep_one_of_each(spark):
    texts = ["a b c d e f", "A b c d e f", "x", "x", None, None, "", "q w e r t y", "q w e r t y"]
    ids = [3, 2, 4, 4, 9, 9, 1, None, 8]
    df = documents(spark, texts, ids, extra="7 AS kept")
    kept = parity_join.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in rows(kept)), key=str) == sorted(
        [(2, "A b c d e f"), (4, "x"), (9, None), (9, None), (1, ""), (8, "q w e r t y")], key=str
    )


def test_keep_one_of_each_takes_no_ids_and_equal_ids_for_groups(spark):
    """Unrelated texts without ids, or with one id, all stay; copies among them do not."""
    texts = ["a b c d e f", "q w e r t y", "q w e r t y", "Q w e r t y", "one two three four", "five six seven eight", "five six seven Eight", None]
    df = documents(spark, texts, [None, None, None, None, 5, 5, 6, None])
    kept = rows(parity_join.keep_one_of_each(df))
    assert sorted(((r["doc_id"], r["text"].lower() if r["text"] else None) for r in kept), key=str) == sorted(
        [(None, "a b c d e f"), (None, "q w e r t y"), (5, "one two three four"), (5, "five six seven eight"), (None, None)], key=str
    )


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (300, 200), (7, 500)] + [(1000, 1000 + i) for i in range(1, 90)]
    random.Random(1).shuffle(edges)
    got = dict((r["node"], r["component"]) for r in rows(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert got == {**{i: 0 for i in [*range(41), 500]}, **{i: 100 for i in (100, 200, 300)}, **{1000 + i: 1000 for i in range(90)}}
    assert rows(components(spark.createDataFrame([], "a bigint, b bigint"))) == []
