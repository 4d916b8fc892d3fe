"""Benchmark passages in training text, by a positional inverted index and built-in expressions only.

Training texts are cut into words once and stored. The stored words give the count of
each test term; from them each window of a test item gets its rarest and second
rarest term. Postings of the rarest terms are stored with their place and the words
around it, so the lists of all other terms of a window, shifted by their offset, can be
intersected at the posting itself, first of all the second rarest one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.ordering import stage

#: Everything in ASCII that is neither a letter nor a digit.
_PARTING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: Test terms or windows up to this many rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: A proximity match shares at least this part of a window's distinct words.
NEAR_SHARE = 0.8


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def split_words(text: Column) -> Column:
    """Words in their own case; the first and the last may be empty."""
    return F.split(F.coalesce(text, F.lit("")), _PARTING, -1)


def word_count(words: Column) -> Column:
    size = F.size(words)
    first = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)
    last = F.when((size > 1) & (F.get(words, size - 1) == ""), 1).otherwise(0)
    return (size - first - last).cast("long")


def text_key(id_column: str, text: str) -> list[Column]:
    """Names a row by its id and text: rows with equal keys are equal in both."""
    return [
        F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text}`")).alias("_key"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_check"),
    ]


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass
class Index:
    """Stored words of the training texts, and alignments of test items with them."""

    #: id, _key, _check, n_words; one row per training row.
    documents: DataFrame
    #: _key, _check, item_id, begin, end, exact; one row per alignment found.
    matches: DataFrame


def _windows(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """The two rarest places of each window that can occur, with the item's words around the rarest."""
    places = items.select("_item", "terms", F.posexplode("terms").alias("place", "term"))
    counted = places.join(counts, F.lower("term") == F.col("_word"), "left").select(
        "_item", "place", F.coalesce("n", F.lit(0)).alias("n")
    )
    size = F.least(F.lit(window), F.size("terms"))
    spans = items.select("_item", "item_id", "terms", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("terms") - size)).alias("begin"))
    inside = spans.select("_item", "begin", F.explode(F.sequence("begin", F.col("begin") + F.col("size") - 1)).alias("place"))
    ranked = (
        inside.join(counted, ["_item", "place"])
        .groupBy("_item", "begin")
        .agg(F.array_sort(F.collect_list(F.struct("n", "place"))).alias("rank"))
        # A term that occurs nowhere rules its windows out.
        .filter(F.get("rank", F.lit(0))["n"] > 0)
    )
    pairs = ranked.select(
        "_item",
        F.get("rank", F.lit(0))["place"].alias("first"),
        F.coalesce(F.get("rank", F.lit(1))["place"], F.get("rank", F.lit(0))["place"]).alias("second"),
    ).distinct()
    reach = window - 1
    low = F.greatest(F.col("first") - reach, F.lit(0))
    return pairs.join(items, "_item").select(
        "item_id",
        F.least(F.lit(window), F.size("terms")).alias("size"),
        F.get("terms", F.col("first")).alias("term"),
        F.lower(F.get("terms", F.col("first"))).alias("_word"),
        F.get("terms", F.col("second")).alias("next_term"),
        F.slice("terms", low + 1, F.lit(2 * reach + 1) - (F.lit(reach) - (F.col("first") - low))).alias("wanted"),
        (F.col("first") - low).alias("wanted_at"),
    )


def _same(i: Column) -> Column:
    mine = F.get("wanted", F.col("wanted_at") + i)
    found = F.get("around", F.col("around_at") + i)
    return F.coalesce(mine == found, F.lit(False))


def _agreeing(steps: Column, reach: int) -> Column:
    """Length of the run of equal words along the steps away from the posting."""
    if reach == 0:
        return F.lit(0)
    first_other = F.array_position(F.transform(steps, _same), F.lit(False)).cast("int")
    return F.when(first_other > 0, first_other - 1).otherwise(reach)


def build_index(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW
) -> Index:
    """Align all test items (``item_id``, ``text``) with all training rows.

    An alignment is exact where ``window`` consecutive words (or all words, of a shorter
    item) are equal, and near where most of a window's words lie around its rarest one in
    any order. NULL, empty and wordless texts on either side have no words and match
    nothing. Rows of ``docs`` with equal id and text share a key and their matches.
    """
    tokens = stage(docs.select(F.col(f"`{id_column}`").alias("id"), *text_key(id_column, text), split_words(F.col(f"`{text}`")).alias("words")))
    terms = F.filter(split_words(ascii_lower(F.col("text"))), lambda w: w != "")
    tests = stage(
        items.select(F.monotonically_increasing_id().alias("_item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), terms.alias("terms")).filter(
            F.size("terms") > 0
        )
    )
    vocabulary = stage(tests.select(F.explode("terms").alias("term")).select(F.lower("term").alias("_word")).distinct())
    known = vocabulary.count()
    counts = stage(
        tokens.select(F.explode("words").alias("raw"))
        .select(F.lower("raw").alias("_word"))
        .join(_bounded(vocabulary, known), "_word", "left_semi")
        .groupBy("_word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    windows = stage(_windows(tests, counts, window))
    held = windows.count()

    reach = window - 1
    begin = F.greatest(F.col("at") - reach, F.lit(0))
    postings = stage(
        tokens.select("_key", "_check", "words", F.posexplode("words").alias("at", "raw"))
        .withColumn("_word", F.lower("raw"))
        .join(_bounded(windows.select("_word").distinct(), known), "_word", "left_semi")
        .select(
            "_word",
            "_key",
            "_check",
            "at",
            F.transform(F.slice("words", begin + 1, F.col("at") - begin + window), ascii_lower).alias("around"),
            (F.col("at") - begin).alias("around_at"),
        )
    )
    # The second list cuts down the first before anything else is compared.
    aligned = (
        postings.join(_bounded(windows, held), "_word")
        .filter((F.get("around", F.col("around_at")) == F.col("term")) & F.array_contains("around", F.col("next_term")))
        .withColumns(
            {
                "left": _agreeing(F.sequence(F.lit(-1), F.lit(-max(reach, 1))), reach),
                "right": _agreeing(F.sequence(F.lit(1), F.lit(max(reach, 1))), reach),
            }
        )
        .withColumn("exact", F.col("left") + F.col("right") + 1 >= F.col("size"))
    )
    shared = F.size(F.array_intersect("wanted", "around"))
    near = shared >= F.least(F.size(F.array_distinct("wanted")), F.col("size")) * NEAR_SHARE
    matches = aligned.filter(F.col("exact") | near).select(
        "_key",
        "_check",
        "item_id",
        (F.col("at") - F.when(F.col("exact"), F.col("left")).otherwise(0)).alias("begin"),
        (F.col("at") + F.when(F.col("exact"), F.col("right")).otherwise(0) + 1).alias("end"),
        "exact",
    )
    return Index(tokens.select("id", "_key", "_check", word_count(F.col("words")).alias("n_words")), matches.distinct())


def covered(spans: Column) -> Column:
    """Words inside any of the spans ``(begin, end)``."""

    def step(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["begin"], state["upto"]), F.lit(0))
        return F.struct(F.greatest(state["upto"], span["end"]).alias("upto"), (state["n"] + fresh).alias("n"))

    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(spans), zero, step)["n"]


def hits(index: Index) -> DataFrame:
    """Per key with any match: words hit, ids of items with exact and with near matches."""
    exact = F.col("exact")
    return index.matches.groupBy("_key", "_check").agg(
        covered(F.collect_set(F.when(exact, F.struct("begin", "end")))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.when(exact, F.col("item_id")))).alias("items"),
        F.array_sort(F.collect_set(F.when(~exact, F.col("item_id")))).alias("near_items"),
    )


def find_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, items, near_items."""
    index = build_index(docs, items, id_column, text, window)
    none = F.array().cast("array<string>")
    return index.documents.join(hits(index), ["_key", "_check"], "left").select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` (all columns) in which no window of a test item occurs."""
    found = stage(hits(build_index(docs, items, id_column, text, window)).filter("n_hit > 0").select("_key", "_check"))
    key, check = text_key(id_column, text)
    packed = docs.select(F.struct("*").alias("_row"), key, check)
    return packed.join(_bounded(found, found.count()), ["_key", "_check"], "left_anti").select("_row.*")
