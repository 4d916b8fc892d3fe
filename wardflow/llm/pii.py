"""Personal data by built-in expressions only.

For each kind a regular expression proposes spans, a checksum or range check confirms
them, and words close by raise the score. A text is split at the matches of a kind, so
the places of the matches are sums of lengths, and the context of a match is the end of
the part before it and the start of the part after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of context on either side.
NEAR = 40
#: Spans under this score are not reported (those of the base kinds always are).
MIN_SCORE = 0.6
#: Matches whose places are summed in one go; blocks of them are summed again.
BLOCK = 128
#: Code points of the pieces that a text with marks is cut into.
PIECE = 1024

_CANDIDATE = "struct<start:bigint,hit:string,before:string,after:string>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits pass the Luhn check (20 digits at most)."""
    padded = F.lpad(_digits(hit), 20, "0")
    total = F.lit(0)
    for i in range(1, 21):
        digit = F.substring(padded, i, 1).cast("int")
        # The last digit counts once, the one before it twice, and so on.
        total = total + (F.pmod(digit * 2, F.lit(10)) + F.when(digit > 4, 1).otherwise(0) if i % 2 else digit)
    return total % 10 == 0


def mod97(hit: Column) -> Column:
    """Whether an account number leaves 1 when divided by 97 (ISO 7064)."""
    packed = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(packed, 5, 64), F.substring(packed, 1, 4))
    letters = F.split(turned, "")

    def step(rest: Column, char: Column) -> Column:
        value = F.ascii(char)
        digit, letter = value - 48, value - 55
        return F.when(char == "", rest).when(value < 65, F.pmod(rest * 10 + digit, F.lit(97))).otherwise(
            F.pmod(rest * 100 + letter, F.lit(97))
        )

    return F.aggregate(letters, F.lit(0), step) == 1


def octets(hit: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")


def digit_count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(_digits(hit)).between(low, high)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Cheap test that a text may hold a match at all.
    hint: str
    valid: Callable[[Column], Column] | None
    context: str
    score: float
    #: Base kinds are reported whatever their score and always go before added ones.
    base: bool = field(default=False)


# The quantifiers are possessive where nothing after them could use what they give back,
# and a match starts where a run starts (or where the match before it ended): both keep
# the work linear in the text and off the stack, and neither changes a match.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", None, r"(?i)mail|contact|kontakt|correo|courriel", 0.9, True,
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".", octets, r"(?i)\bip\b|address|host|server|login", 0.6, True,
    ),
    Kind(
        "card",
        # A whole chain of single-parted digits, if it has 12 to 19 of them.
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
        "", luhn, r"(?i)card|visa|master|amex|credit|karte|carte|tarjeta", 0.8, True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+", digit_count(9, 15), r"(?i)tel|phone|call|fax|mobil|tél|móvil", 0.8, True,
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "", mod97, r"(?i)iban|account|konto|compte|cuenta|bank", 0.7,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "-", None, r"(?i)\bssn\b|social security|tax id", 0.4,
    ),
    Kind(
        "tel",
        r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
        "", digit_count(10, 10), r"(?i)tel|phone|call|fax|mobil|tél|móvil", 0.4,
    ),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _block(pieces: Column, hits: Column, first: Column) -> Column:
    """Length covered by a block of matches, and its candidates with places from the block's start."""
    last = F.least(first + (BLOCK - 1), F.size(hits) - 1)

    def step(state: Column, i: Column) -> Column:
        piece, hit = F.get(pieces, i), F.get(hits, i)
        start = state["at"] + F.length(piece)
        found = F.struct(
            start.alias("start"),
            hit.alias("hit"),
            F.right(piece, F.lit(NEAR)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(NEAR)).alias("after"),
        )
        return F.struct((start + F.length(hit)).alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_CANDIDATE}>").alias("found"))
    return F.aggregate(F.sequence(first, last), zero, step)


def _candidates(pieces: Column, hits: Column) -> Column:
    """All matches with their places, by sums within blocks and then over blocks."""
    none = F.array().cast(f"array<{_CANDIDATE}>")
    firsts = F.sequence(F.lit(0), F.greatest(F.size(hits) - 1, F.lit(0)), F.lit(BLOCK))
    blocks = F.transform(firsts, lambda first: _block(pieces, hits, first))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))

    def step(state: Column, block: Column) -> Column:
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    def shifted(block: Column, start: Column) -> Column:
        return F.transform(
            block["found"],
            lambda c: F.struct(
                (c["start"] + start).alias("start"), c["hit"].alias("hit"), c["before"].alias("before"), c["after"].alias("after")
            ),
        )

    def whole(found: Column) -> Column:
        return F.flatten(F.zip_with(found, F.aggregate(found, zero, step)["starts"], shifted))

    return F.when(F.size(hits) > 0, whole(blocks)).otherwise(none)


def _scored(kind: Kind, rank: int, candidates: Column) -> Column:
    """Confirmed candidates as spans ``(start, rank, end, kind, score)``."""

    def span(c: Column) -> Column:
        near = F.concat_ws(" ", c["before"], c["after"]).rlike(kind.context)
        return F.struct(
            c["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (c["start"] + F.length(c["hit"])).alias("end"),
            F.lit(kind.name).alias("kind"),
            F.round(F.lit(kind.score) + F.when(near, (1 - kind.score) / 2).otherwise(0.0), 4).alias("score"),
        )

    kept = F.filter(candidates, lambda c: kind.valid(c["hit"])) if kind.valid else candidates
    return F.transform(kept, span)


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``spans``, an array of ``(start, rank, end, kind, score)`` by start, then kind.

    Places are code points from 0, the end excluded, over the whole text. Base kinds are
    all matches that pass their check; an added kind counts from ``MIN_SCORE`` on where no
    base span overlaps it. NULL and empty texts have no spans. Rows are neither joined nor
    moved; a column of ``df`` named ``spans`` is replaced, others may have any name. The
    work on a very long text grows with its length and, for each added span, with the
    logarithm of the number of base spans.
    """
    source = F.coalesce(F.col("_text"), F.lit(""))
    kept = [c for c in df.columns if c != "spans"]
    none = F.array().cast("array<string>")
    # Packed, no column of the rows can clash with a column of the search.
    packed = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(0)
    out = df.select(packed.alias("_row"), F.col(f"`{text}`").alias("_text"))
    out = out.withColumns(
        {
            f"_hits_{k.name}": F.when(
                F.contains(source, F.lit(k.hint)) if k.hint else F.lit(True),
                F.regexp_extract_all(source, F.lit(k.pattern), F.lit(0)),
            ).otherwise(none)
            for k in KINDS
        }
    )
    out = out.withColumns(
        {
            f"_parts_{k.name}": F.when(F.size(f"_hits_{k.name}") > 0, F.split(source, k.pattern, -1)).otherwise(none)
            for k in KINDS
        }
    )
    out = out.withColumns({f"_at_{k.name}": _candidates(F.col(f"_parts_{k.name}"), F.col(f"_hits_{k.name}")) for k in KINDS})
    spans = {k.name: _scored(k, i, F.col(f"_at_{k.name}")) for i, k in enumerate(KINDS)}
    out = out.select(
        "_row",
        *[spans[k.name].alias(f"_base_{k.name}") for k in KINDS if k.base],
        F.concat(*[spans[k.name] for k in KINDS if not k.base]).alias("_added"),
    )
    base = [F.col(f"_base_{k.name}") for k in KINDS if k.base]

    def free(span: Column) -> Column:
        return (span["score"] >= MIN_SCORE) & ~reduce(or_, [_overlaps(of_kind, span) for of_kind in base])

    found = F.array_sort(F.concat(*base, F.filter("_added", free)))
    out = out.select("_row", found.alias("_spans"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], F.col("_spans").alias("spans"))


def _overlaps(ordered: Column, span: Column) -> Column:
    """Whether one of the spans of a kind, which are in order and apart, overlaps another span.

    The last one that starts before the other's end decides; it is found by halving.
    """
    size = F.size(ordered)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        before = (at["low"] < at["high"]) & (F.get(ordered, middle)["start"] < span["end"])
        low = F.when(before, middle + 1).otherwise(at["low"])
        high = F.when(before | (at["low"] >= at["high"]), at["high"]).otherwise(middle)
        return F.struct(low.alias("low"), high.alias("high"))

    whole = F.struct(F.lit(0).alias("low"), size.alias("high"))
    last = F.aggregate(steps, whole, halve)["low"] - 1
    return (size > 0) & F.coalesce((last >= 0) & (F.get(ordered, last)["end"] > span["start"]), F.lit(False))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(BASE))


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span of personal data in its text replaced by its kind in brackets.

    Overlapping spans become one, named after the first of them. A NULL text stays NULL.
    """
    found = find_personal_data(df.select(F.struct("*").alias("_row"), F.col(f"`{text}`").alias("_whole")), "_whole")
    marks = "array<struct<start:bigint,end:bigint,kind:string>>"

    def merge(done: Column, span: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        new = F.struct(span["start"].alias("start"), span["end"].alias("end"), span["kind"].alias("kind"))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when(
            (F.size(done) > 0) & (span["start"] < last["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
        ).otherwise(F.concat(done, F.array(new)))

    merged = F.when(F.size("spans") > 0, F.aggregate("spans", F.array().cast(marks), merge)).otherwise(F.array().cast(marks))
    out = found.withColumn("_marks", merged)
    # The text in pieces of equal length, so that a place is reached without walking there.
    pieces = F.regexp_extract_all("_whole", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    out = out.withColumn("_pieces", F.when(F.size("_marks") > 0, pieces))

    def cut(start: Column, end: Column) -> Column:
        first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
        near = F.array_join(F.slice("_pieces", first + 1, last - first + 1), "")
        return F.when(end > start, F.substr(near, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))).otherwise("")

    def before(mark: Column, i: Column) -> Column:
        # The text from the end of the mark before, and the mark itself.
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("_marks", i - 1)["end"])
        return F.concat(cut(start, mark["start"]), F.lit("["), F.upper(mark["kind"]), F.lit("]"))

    tail = cut(F.get("_marks", F.size("_marks") - 1)["end"], F.length("_whole"))
    masked = F.when(
        F.size("_marks") > 0, F.concat(F.array_join(F.transform("_marks", before), ""), tail)
    ).otherwise(F.col("_whole"))
    columns = [masked.alias(c) if c == text else F.col("_row")[c].alias(c) for c in df.columns]
    return out.select(*columns)
