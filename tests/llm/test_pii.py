import hashlib
import re
import time

import pytest

from tests.llm.support import documents, folder, given, rows
from wardflow.llm import pii
from wardflow.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def brute(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return sorted(found)


TEXTS = [
    None,
    "",
    "write to a.b@c-d.example.com or x@y.z_w@q.r, abc@.def@x.y and a@b",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.001.2.03 1..2.3.4 9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 411111111111111 12-34",
    "4111111111111111 5 4111111111111111 0000 0000 0000 45393195034360991234567890",
    "call +49 (30) 1234-5678 or +1 743 555 3824. +1+2345678901 +12 ...",
    "é🎉 4111111111111111 🎉 mail é@x.de ü.x@y.de",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB83WEST12345698765432, ssn 123-45-6789, id 123-45-6789x",
    "tel (743) 555-3824 and 743.555.3825",
    "7" * 30_000 + "a" * 30_000 + "@" + " " * 1000 + "x.y@z.com" + "1-" * 20_000,
    "4111111111111111 a@b.co " * 700,
]


def test_spans_match_brute_force(spark):
    """Base kinds, places in code points, on awkward and given texts."""
    texts = TEXTS + [d["text"] for d in given("documents")]
    found = rows(pii.find_personal_data(documents(spark, texts).select("doc_id", "text")))
    for row in found:
        got = [(s["start"], s["rank"], s["end"], s["kind"]) for s in row["spans"] if s["rank"] < 4]
        assert got == brute(row["text"]), row["doc_id"]


def test_added_kinds_need_checks_or_context(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32", "GB83WEST12345698765432", "ssn 123-45-6789", "part 123-45-6789", "tel 743.555.3825"]
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in rows(pii.find_personal_data(documents(spark, texts)))}
    assert found == {0: ["iban"], 1: [], 2: ["ssn"], 3: [], 4: ["tel"]}


def test_context_raises_the_score(spark):
    found = rows(pii.find_personal_data(documents(spark, ["visa 4111111111111111", "4111111111111111"])))
    scores = [r["spans"][0]["score"] for r in sorted(found, key=lambda r: r["doc_id"])]
    assert scores == [pytest.approx(0.9), pytest.approx(0.8)]


def test_query_digests(spark):
    place = folder(spark, documents=documents(spark, TEXTS + TEXTS, extra="'x' AS spans"))
    got = rows(QUERIES["op1_pii"](spark, place))
    assert len(got) == 2 * len(TEXTS)
    for row in got:
        spans = brute((TEXTS + TEXTS)[row["doc_id"]])
        base = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[3] == k for s in spans) for k in pii.BASE]
        assert set(base.split(",")) - {""} <= set(row["spans"].split(","))


def test_mask_and_empty_table(spark):
    df = documents(spark, ["a é x@y.de, +1 (743) 555-3824!", None, "none", "+1 192.168.1.1 55 z"], extra="1 AS _marks")
    got = {r["doc_id"]: r for r in rows(pii.mask(df))}
    assert got[0]["text"] == "a é [EMAIL], [PHONE]!"
    assert got[1]["text"] is None and got[2]["text"] == "none"
    assert got[3]["text"] == "[PHONE] z"
    assert got[0]["_marks"] == 1 and pii.mask(df).columns == df.columns
    assert pii.mask(df.limit(0)).count() == 0 and pii.find_personal_data(df.limit(0)).count() == 0


def test_columns_of_any_name(spark):
    df = documents(spark, ["x@y.de"], extra="'mine' AS _text").selectExpr("*", "1 AS _hits_email", "2 AS _parts_ip", "3 AS _at_card", "4 AS _row", "5 AS _base_email", "6 AS _added", "7 AS _pieces")
    row = rows(pii.find_personal_data(df))[0]
    assert [(s["start"], s["end"], s["kind"]) for s in row["spans"]] == [(0, 6, "email")]
    own = {c: row[c] for c in df.columns if c.startswith("_")}
    assert own == {"_text": "mine", "_hits_email": 1, "_parts_ip": 2, "_at_card": 3, "_row": 4, "_base_email": 5, "_added": 6, "_pieces": 7}
    masked = rows(pii.mask(df))[0]
    assert masked["text"] == "[EMAIL]" and {c: masked[c] for c in own} == own
    assert [s["kind"] for s in rows(pii.find_personal_data(df, "_text"))[0]["spans"]] == []


def test_long_texts_with_very_many_matches(spark):
    """The time is about that of the text's length: it was quadratic in the matches before."""
    unit = "mail a.b@c-d.org ssn 123-45-6789 é "
    seconds = {}
    for times in (1, 1500, 6000):
        df = documents(spark, [unit * times])
        began = time.perf_counter()
        spans = rows(pii.find_personal_data(df))[0]["spans"]
        masked = rows(pii.mask(df))[0]["text"]
        seconds[times] = time.perf_counter() - began
        assert len(spans) == 2 * times and masked == "mail [EMAIL] ssn [SSN] é " * times
    assert seconds[6000] < 10 * max(seconds[1500], 2)


def test_added_spans_under_base_spans_of_every_kind(spark):
    """Against a comparison of each added span with all base spans."""
    texts = [
        "ssn 123-45-6789@x.de and 123-45-6789", "IBAN GB82 WEST 1234 5698 7654 32 card 4111111111111111 ssn 123-45-6789",
        "tel 743.555.3825 1.2.3.4 tel 10.20.30.40 +1 743 555 3824", "tel (743) 555-3824 " * 40 + "x@y.de ssn 123-45-6789 " * 40,
    ]
    for row in rows(pii.find_personal_data(documents(spark, texts))):
        base = [s for s in row["spans"] if s["rank"] < len(pii.BASE)]
        added = [s for s in row["spans"] if s["rank"] >= len(pii.BASE)]
        assert not [1 for s in added for b in base if b["start"] < s["end"] and s["start"] < b["end"]]
        if row["doc_id"] in (1, 3):
            assert {s["kind"] for s in added} >= {1: {"ssn"}, 3: {"tel"}}[row["doc_id"]]
