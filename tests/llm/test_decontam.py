import re

from pyspark.sql import functions as F

from mdlake.llm import decontam
from mdlake.llm.common import word_count  # noqa: F401

UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def slow(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    widths = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = words_of(text)
        hit, ids = set(), set()
        for n in widths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    ids |= found
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


def found(docs, items):
    rows = decontam.contamination(docs, items).collect()
    for r in rows:
        assert r.n_hit == sum(h.end - h.start for h in r.hits)
        assert all(a.end < b.start for a, b in zip(r.hits, r.hits[1:]))
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in rows), key=str)


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id BIGINT, text STRING")


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "one, TWO three four five six seven eight nine ten"),
    (3, "tiny item"),
    (4, None),
    (5, " ... "),
    (None, "x y z"),
    (6, "a a a a a a a a a a a a"),
    (7, "\u00e9t\u00e9 9"),
]


def test_windows_short_items_and_runs(spark):
    texts = [
        "zero one two three four five six seven eight nine ten eleven end",
        "one two three four five six seven eight nine",
        "a TINY-item here; tiny\titem. X y Z",
        "a " * 25,
        None,
        "",
        "\u00c9t\u00e9 9 \u00e9t\u00e9 9",
        "the " * 3000 + ITEMS[0][1] + " and" * 3000,
        "tiny",
    ]
    docs = list(enumerate(texts)) + [(0, texts[0]), (None, "tiny item")]
    table = spark.createDataFrame([(*d, "c") for d in docs], "doc_id BIGINT, text STRING, row STRING").repartition(3)
    assert found(table, item_table(spark, ITEMS)) == slow(docs, ITEMS)


def test_cut_texts(monkeypatch, spark):
    """Long texts are hashed block by block; no window is lost or doubled at a cut."""
    import pyarrow as pa

    text = " ".join(f"w{i % 37}" for i in range(500)) + " " + "q" * 300 + " tail of it"
    column = pa.array([text, "short one", None, text])

    def every(size):
        monkeypatch.setattr(decontam, "BLOCK", size)
        out = []
        for _, _, row, start, width, fp, span in decontam.spans(column, (2, 9), None, True):
            out += zip(row.tolist(), start.tolist(), width.tolist(), fp.tolist(), span.tolist())
        return sorted(out)

    assert every(50) == every(1 << 19)


def test_every_shared_span_is_found(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = slow([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(documents, items) == want


def test_small_bitmap_only_costs_time(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    few = decontam.contamination(documents, items, filter_bits=64).agg(F.sum("n_hit")).first()[0]
    assert few == decontam.contamination(documents, items).agg(F.sum("n_hit")).first()[0]


def test_no_rows(spark, none, odd, odd_rows):
    assert found(none, item_table(spark, ITEMS)) == []
    got = found(odd, item_table(spark, []))
    assert len(got) == len(odd_rows) and all(r[2] == 0 for r in got)
