import random
import re
import time

from mdlake.llm import pii
from mdlake.llm.queries import QUERIES


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])) % 10 == 0


def only_digits(match):
    return re.sub("[^0-9]", "", match)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(only_digits(m)) <= 15),
)


def slow(text):
    found = []
    for rank, (kind, pattern, valid) in enumerate(BASE):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(m[0])]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def base_of(rows):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in rows}


def test_base_spans_against_plain_expressions(spark):
    rng = random.Random(5)
    parts = [
        "a.b+c@d-e.f.g", "@", ".", "x@y", "@z.org", "_", "1.2.3.4", "5.6.7.8.9", "256.1.1.1", "0001.2.3.004", "4111 1111-1111 1111",
        "4111111111111111", "12", "-", " ", "+1 (555) 010-9999", "+49 30.123", "+", "\U0001f600", "\u00e9", "\n", "79927398713000", "%",
        "30569309025904", "6011000990139424 7",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [None, "", "1" * 50_000, "a" * 50_000 + "@", "1-" * 30_000, "1.2.3.4." * 2000, "+" * 1000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(4)
    got = base_of(pii.find(docs, ["doc_id"]).collect())
    assert got == {i: slow(t) for i, t in enumerate(texts)}


def test_account_numbers_and_context(spark):
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00 thanks"),
        (2, "IBAN DE89 3704 0044 0532 0130 01 thanks"),
        (3, "call +1 555 010 9999"),
        (4, "invoice +1 555 010 9999"),
    ]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), ["doc_id"]).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1] if not s.base] == [("iban", 5, 32)]
    assert not [s for s in got[2] if s.kind == "iban"]
    assert got[3][0].score > got[4][0].score


def test_account_numbers_before_capitals_digits_and_marks(spark):
    numbers = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "NO9386011117947"]
    after = ["", " Please pay", " EUR 50", " 12 units", " A", ".", ",5", ")", "\nNext", " DE89370400440532013000 X", "X", "7"]
    rows = [(i, f"to {n}{tail}", n, tail) for i, (n, tail) in enumerate((n, t) for n in numbers for t in after)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, number STRING, tail STRING")
    for r in pii.find(docs, ["doc_id", "number", "tail"]).collect():
        spans = [(s.start, s.end) for s in r.spans if s.kind == "iban"]
        wanted = [] if r.tail in ("X", "7") else [(3, 3 + len(r.number))]
        if r.tail.startswith(" DE"):
            wanted.append((4 + len(r.number), 26 + len(r.number)))
        assert spans == wanted, (r.number, r.tail)


def test_query(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_pii"](spark, sf_dir).collect()}
    for r in documents.collect():
        spans = slow(r.text)
        assert [rows[r.doc_id][f"n_{k}"] for k, _, _ in BASE] == [sum(s[0] == k for s in spans) for k, _, _ in BASE]


def test_odd_rows(odd, odd_rows, none):
    got = pii.find(odd, ["doc_id", "row"]).collect()
    assert len(got) == len(odd_rows) and all(r.spans == [] for r in got)
    assert pii.find(none, ["doc_id"]).count() == 0


def test_many_matches_in_one_text(spark):
    """Contacts by the thousand, at their places; a text ten times as long takes little longer than ten times."""
    def text(n):
        return "".join(f"mail a{i}@b.org, +49 30 {1000000 + i}; \u00e9\U0001f600 10.0.{i % 300}.1\n" for i in range(n))

    def took(n):
        docs = spark.createDataFrame([(1, text(n))], "doc_id BIGINT, text STRING")
        began = time.monotonic()
        assert base_of(pii.find(docs, ["doc_id"]).collect()) == {1: slow(text(n))}
        return time.monotonic() - began

    took(10)
    short = took(2_000)
    assert took(20_000) < 20 * short + 5
