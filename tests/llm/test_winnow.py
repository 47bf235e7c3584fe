import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from mdlake.llm import winnow
from mdlake.llm.queries import QUERIES


def longs(*values):
    """xxhash64 of long columns: each is hashed with the one before as seed."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed &= (1 << 64) - 1
    return seed - (1 << 64) if seed >> 63 else seed


def text_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def slow(text):
    runs = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tokens = [t for run in runs for t in ([run] if len(run) <= 16 else run)]
    h = [text_hash(t) for t in tokens]
    if len(h) >= 4:
        two = [longs(a, b) for a, b in zip(h, h[1:])]
        grams = [longs(two[i], two[i + 2]) for i in range(len(h) - 3)]
    else:
        grams = [longs(*h)] if h else []
    picked = []
    windows = range(len(grams) - 3) if len(grams) >= 4 else range(min(1, len(grams)))
    for i in windows:
        least = min((g & winnow.HASH_BITS, -j) for j, g in enumerate(grams[i : i + 4], i))
        if -least[1] not in picked:
            picked.append(-least[1])
    return [(grams[p], p) for p in picked]


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, given):
    order = sorted(given, key=lambda r: (r[0] is not None, r[0] or 0))
    got = {r.doc_id: r for r in rows}
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert [(x.hash, x.position) for x in r.fingerprint] == slow(text)
        assert [(x.hash, x.position) for x in r.edited_fingerprint] == slow(edited)
        assert r.near_edited == pytest.approx(alike(slow(text), slow(edited)))
        assert r.near_next == pytest.approx(alike(slow(text), slow(after)))


def test_all_documents(documents):
    given = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    check(winnow.edited_fingerprints(documents).collect(), given)


def test_odd_rows(spark, odd_rows):
    rows = list({(r[0], r[1]) for r in odd_rows})
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id BIGINT, text STRING, fingerprint STRING").repartition(3)
    check(winnow.edited_fingerprints(docs).collect(), rows)


def test_repeated_and_no_rows(odd, odd_rows, none):
    assert winnow.edited_fingerprints(odd).count() == len(odd_rows)
    assert winnow.edited_fingerprints(none).count() == 0


def test_one_document_follows_itself(spark):
    r = winnow.edited_fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id BIGINT, text STRING")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0


def test_rightmost_of_equal_hashes(spark):
    rows = winnow.with_fingerprint(spark.createDataFrame([("a " * 10,)], "text STRING"), "text", "f").first()
    assert [x.position for x in rows.f] == [3, 4, 5, 6]


def test_shared_spans_are_found(spark):
    shared = "one two three four five six seven"
    rows = [(1, f"p q r {shared} s t"), (2, f"{shared} u v w x y"), (3, "p q r s t u v w x y z")]
    made = winnow.with_fingerprint(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), "text", "f")
    got = {r.doc_id: {x.hash: x.position for x in r.f} for r in made.collect()}
    common = got[1].keys() & got[2].keys()
    assert common and all(got[1][h] - got[2][h] == 3 for h in common)
    assert not got[1].keys() & got[3].keys()


def test_unspaced_passage_at_every_offset(spark):
    passage = "".join(chr(0x4E00 + (i * 7919) % 20000) for i in range(200))
    rows = [(i, "".join(chr(0x3041 + j) for j in range(i)) + passage) for i in range(17)] + [(17, "one two " + passage + "x end")]
    made = winnow.with_fingerprint(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), "text", "f")
    got = {r.doc_id: {x.hash: x.position for x in r.f} for r in made.collect()}
    for i in range(1, 18):
        common = got[0].keys() & got[i].keys()
        shift = 2 if i == 17 else i
        assert len(common) > 0.9 * len(got[0]) and all(got[i][h] - got[0][h] == shift for h in common)


def test_query_digests(spark, sf_dir):
    rows = QUERIES["op9_fingerprints"](spark, sf_dir)
    assert rows.filter(~F.col("fingerprint").rlike("^[0-9a-f]{16}$")).count() == 0
