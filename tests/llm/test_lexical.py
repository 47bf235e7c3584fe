import math
import re
from collections import Counter

import numpy as np

from mdlake.llm import lexical
from mdlake.llm.queries import QUERIES

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
ITEMS = "item_id STRING, text STRING, doc_id STRING, rank STRING"


def terms(text):
    return TERM.findall((text or "").encode().lower())


def slow(docs, items, top=20):
    """{(item, rank, doc_id, score): times} by scoring every document for every item."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    N, L = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = Counter()
    for item, text in items:
        rows = []
        for doc, c, n in counts:
            m = 75 + (25 * n * N) // L
            score = 0
            for t, times in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0))
        for rank, (score, unnamed, doc) in enumerate(sorted(rows)[:top], 1):
            out[item, rank, None if unnamed else doc, -score] += 1
    return out


def found(docs, items, **options):
    return Counter(tuple(r) for r in lexical.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect())


def test_query_against_brute_force(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = slow([(r.doc_id, r.text) for r in documents.collect()], items)
    rows = QUERIES["op11_lexical"](spark, sf_dir).collect()
    assert Counter((r.item_id, r.rank, r.doc_id, r.score) for r in rows) == want


def test_odd_rows_and_blocks(spark, odd, odd_rows, monkeypatch):
    """Nulls, long and repeated texts, ties, items that repeat; small blocks, pieces and steps change nothing."""
    given = [("a", "w7919 W15838 ONE one"), ("b", None), (None, "no id AT all"), ("a", "w7919 W15838 ONE one"), ("c", " !?"), ("d", "é x unseen")]
    given += [("e", odd_rows[5][1][:3000])]
    items = spark.createDataFrame([(*i, "x", "y") for i in given], ITEMS)
    want = slow([(r[0], r[1]) for r in odd_rows], given)
    assert found(odd, items) == want
    monkeypatch.setattr(lexical, "CELLS", 1)
    monkeypatch.setattr(lexical, "BLOCK", 4096)
    assert found(odd, items, block_terms=5) == want
    assert found(odd, items, top=2) == slow([(r[0], r[1]) for r in odd_rows], given, 2)


def test_empty(spark, none, odd):
    items = spark.createDataFrame([("a", "one two", "x", "y")], ITEMS)
    assert found(none, items) == Counter()
    assert found(odd, items.limit(0)) == Counter()


def test_many_ties(spark):
    docs = spark.createDataFrame([(i, "same words") for i in range(3000)] + [(-i, "other") for i in range(1, 900)], "doc_id BIGINT, text STRING").repartition(6)
    got = found(docs, spark.createDataFrame([("q", "words", "x", "y")], ITEMS))
    assert sorted((rank, doc) for _, rank, doc, _ in got) == [(i + 1, i) for i in range(20)]


def test_plan_shares_and_adds_up():
    """Accumulators made along the graph equal the plain sums, with fewer additions."""
    rng = np.random.default_rng(5)
    common = [set(rng.integers(0, 400, 12).tolist()) for _ in range(6)]
    queries = []
    for i in range(60):
        q = {int(t): 1 for t in rng.integers(400, 3000, 5)}
        for j in {i % 6, i * 7 % 6, 0}:
            q.update({t: 1 for t in common[j]})
        if i % 10 == 0:
            q[next(iter(common[0]))] = 3
        queries.append(q)
    plan = lexical.Plan(queries)
    values = {int(t): int(t) ** 2 + 1 for t in plan.terms}
    table = [values[int(t)] for t in plan.terms]
    for parts in plan.nodes:
        assert max(parts) < len(table)
        table.append(sum(table[p] for p in parts))
    for query, parts in zip(queries, plan.queries):
        assert sum(table[p] * n for p, n in parts) == sum(values[t] * n for t, n in query.items())
    assert plan.additions() < 0.7 * sum(map(len, queries))
    shared = [q for q in plan.queries if any(p >= len(plan.terms) for p, _ in q)]
    assert len(shared) == len(queries)
