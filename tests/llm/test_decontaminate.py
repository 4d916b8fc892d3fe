import hashlib

from tests.llm.support import documents, folder, given, rows
from tests.llm.test_licenses import WORD, lower
from wardflow.llm import decontaminate
from wardflow.llm.queries import QUERIES


def brute(texts, items, window=10):
    """Mark every word of every text that lies in an occurrence of a window, one by one."""
    grams = {}
    for item_id, text in items:
        words = WORD.findall(lower(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if words else ():
            grams.setdefault(tuple(words[i : i + size]), set()).add(str(item_id))
    sizes = {len(g) for g in grams}
    out = []
    for text in texts:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                ids = grams.get(tuple(words[i : i + size]))
                if ids:
                    hit.update(range(i, i + size))
                    found |= ids
        out.append((len(words), len(hit), sorted(found)))
    return out


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (10, "the the the the the the the the the the the"),
    (2, "Short ITEM"),
    (3, "..."),
    (4, None),
    (5, "É kelvin K ſ a b c d e f g h i j k l"),
    (6, "one two three four five six seven eight nine ten"),
]
TEXTS = [
    None,
    "",
    "?!",
    "x one two three four five six seven eight nine ten eleven twelve y",
    "...ONE, two three-four five six seven eight nine\nten. " * 3,
    "the " * 25,
    "a short item and a short, item",
    "short",
    "é kelvin K ſ a b c d e f g h i j k l",
    "É kelvin K ſ a b c d e f g h i j k l",
    "ten nine eight seven six five four three two one",
    "one two three four five six seven eight nine x ten",
    "filler " * 50_000 + "two three four five six seven eight nine ten eleven twelve " + "filler " * 10,
]


def check(spark, texts, items, ids=None):
    docs = documents(spark, texts, ids, extra="1 AS words")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    got = rows(QUERIES["op7_decontaminate"](spark, folder(spark, documents=docs, benchmark=tests)))
    wanted = brute(texts, items)
    assert len(got) == len(texts)
    digest = lambda found: hashlib.sha256(",".join(found).encode()).hexdigest()
    ids = range(len(texts)) if ids is None else ids
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == sorted(
        (str(i), n, h, len(f), digest(f), h > 0) for i, (n, h, f) in zip(ids, wanted)
    )


def test_awkward_cases_match_brute_force(spark):
    # Repeated rows, a repeated id with another text, and NULL ids.
    texts = TEXTS + TEXTS[:5] + [TEXTS[3], "none at all", TEXTS[5]]
    check(spark, texts, ITEMS, [*range(len(TEXTS)), *range(5), 0, None, None])


def test_given_documents_match_brute_force(spark):
    docs = given("documents", "sf0.01")[:400]
    items = [(b["item_id"], b["text"]) for b in given("benchmark", "sf0.01")]
    texts = [d["text"] for d in docs]
    assert sum(h > 0 for _, h, _ in brute(texts, items)) > 3
    check(spark, texts, items)


def test_empty_tables(spark):
    docs, tests = documents(spark, ["a b"]), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.find_contaminated(docs.limit(0), tests).count() == 0
    assert [r["n_hit"] for r in rows(decontaminate.find_contaminated(docs, tests.limit(0)))] == [0]


def test_near_matches_and_dropping(spark):
    tests = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    docs = documents(spark, ["six five four three two one twelve eleven ten nine eight seven", TEXTS[3], None], extra="2 AS _key")
    got = {r["doc_id"]: r for r in rows(decontaminate.find_contaminated(docs, tests))}
    assert got[0]["n_hit"] == 0 and got[0]["near_items"] == ["1"]
    kept = decontaminate.drop_contaminated(docs, tests)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in rows(kept)) == [0, 2]
